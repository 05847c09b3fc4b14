"""Fill-in-the-middle transformation of documents with a piece table.

A document is a list of descriptors (buffer, start, end) over two buffers that never change: its text, and the
sentinels. To cut is to split a descriptor in two, to arrange is to put descriptors in another order, with
sentinels among them; no text is moved or copied until a result is read. A result is read piece by piece, so its hash
needs no copy either. To restore a text, descriptors over the *output* are cut at the sentinels found there, and put
back by the inverse of the form's order.

Where a document is cut, and its form, come from a hash of its id and of nothing else, so reruns agree however
rows are dealt. A text in which a sentinel stands, or with nothing in it, is left plain: so every output can be read
back without knowing the cuts.

Defined results: a null or empty text is plain, of no code points; a null id hashes as the empty text; a very long text is
cut as a whole; repeated rows give equal rows; an empty table gives no rows; ``transform`` leaves other columns as
they are but for the named new one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import quoted, struct_of, table

SENTINELS = ("<P>", "<S>", "<M>")
#: Of 100 documents so many are cut, and of 100 cut ones so many have the suffix first.
CUT_OF_100, SUFFIX_FIRST_OF_100 = 90, 20
SEED = 1
PREFIX, MIDDLE, SUFFIX = 0, 1, 2
#: The order of the parts in a form, each behind its sentinel.
FORMS = {
    "psm": ((PREFIX, "<P>"), (SUFFIX, "<S>"), (MIDDLE, "<M>")),
    "spm": ((SUFFIX, "<S>"), (PREFIX, "<P>"), (MIDDLE, "<M>")),
}
TEXT, MARKS = 0, 1


class PieceTable:
    """Descriptors (buffer, start, end) over a text and the sentinels."""

    def __init__(self, text: str, pieces: list[tuple[int, int, int]] | None = None):
        self.buffers = (text, "".join(SENTINELS))
        self.pieces = [(TEXT, 0, len(text))] if pieces is None else pieces

    def cut(self, *places: int) -> PieceTable:
        """Descriptors split at places of the document, in rising order; a place twice leaves an empty piece between."""
        out, at, rest = [], 0, list(places)
        for buffer, start, end in self.pieces:
            while rest and rest[0] <= at + end - start:
                middle = start + rest.pop(0) - at
                out.append((buffer, start, middle))
                at, start = at + middle - out[-1][1], middle
            out.append((buffer, start, end))
            at += end - start
        return PieceTable(self.buffers[TEXT], out)

    def arranged(self, form: str) -> PieceTable:
        """Three pieces in the order of a form, each behind its sentinel."""
        out = []
        for part, mark in FORMS[form]:
            at = self.buffers[MARKS].index(mark)
            out += [(MARKS, at, at + len(mark)), self.pieces[part]]
        return PieceTable(self.buffers[TEXT], out)

    def restored(self, form: str) -> PieceTable:
        """The inverse: of six pieces (sentinel, part, ...) the parts, in the order of the text."""
        inverse = {part: self.pieces[2 * k + 1] for k, (part, _) in enumerate(FORMS[form])}
        return PieceTable(self.buffers[TEXT], [inverse[part] for part in (PREFIX, MIDDLE, SUFFIX)])

    def read(self) -> Iterator[str]:
        return (self.buffers[b][start:end] for b, start, end in self.pieces)

    def text(self) -> str:
        return "".join(self.read())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for piece in self.read():
            digest.update(piece.encode("utf-8", "surrogatepass"))
        return digest.hexdigest()


def choices(doc_id: int | None, n: int, seed: int = SEED) -> tuple[int, int, str]:
    """Both cuts, and the form, of a document of n code points."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    form = "plain" if n == 0 or h3 % 100 >= CUT_OF_100 else "spm" if h4 % 100 < SUFFIX_FIRST_OF_100 else "psm"
    return a, b, form


def divide(doc_id: int | None, text: str, seed: int = SEED) -> tuple[PieceTable, str, int | None, int | None]:
    """The arranged document, its form, and the lengths of prefix and middle (none if plain)."""
    a, b, form = choices(doc_id, len(text), seed)
    if form == "plain" or any(s in text for s in SENTINELS):
        return PieceTable(text), "plain", None, None
    return PieceTable(text).cut(a, b).arranged(form), form, a, b - a


def rebuild(output: str, form: str) -> PieceTable:
    """The document behind an output, from the output and its form alone. No part holds a sentinel, so the first place
    of each is the place where it was put."""
    if form == "plain":
        return PieceTable(output)
    places, at = [], 0
    for _, mark in FORMS[form]:
        at = output.index(mark, at)
        places += [at, at + len(mark)]
        at += len(mark)
    return PieceTable(output).cut(*places[1:]).restored(form)


FIELDS = "output string, form string, prefix_chars long, middle_chars long"
DIGESTS = "n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


def _longs(frame: pd.DataFrame) -> pd.DataFrame:
    """Lengths that may be missing as whole numbers."""
    return frame.astype({c: "Int64" for c in ("prefix_chars", "middle_chars")})


def _ids(ids: pd.Series) -> list[int | None]:
    return [None if pd.isna(i) else int(i) for i in ids]


def _per_document(fn, fields: str, doc_id: str, text: str) -> Column:
    """A pandas UDF of ids (as decimal text, so that none is rounded) and whole texts."""
    names = [f.split(" ")[0] for f in fields.split(", ")]

    def run(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        return _longs(pd.DataFrame([fn(i, t or "") for i, t in zip(_ids(ids), texts)], columns=names))

    run.__annotations__ = {"ids": pd.Series, "texts": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, struct_of(fields)).asNondeterministic()(quoted(doc_id).cast("long").cast("string"), quoted(text))


def transform(docs: DataFrame, out: str = "fim", doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """The documents with a struct column ``out``: ``output``, ``form``, ``prefix_chars`` and ``middle_chars``."""

    def one(i: int | None, t: str) -> tuple:
        pieces, *rest = divide(i, t, seed)
        return pieces.text(), *rest

    return docs.withColumn(out, _per_document(one, FIELDS, doc_id, text))


def restore(docs: DataFrame, output: str, form: str, out: str = "restored") -> DataFrame:
    """The documents with the text rebuilt from two columns, in a column ``out``; a null output gives null."""

    def run(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([None if o is None else rebuild(o, f).text() for o, f in zip(outputs, forms)], dtype=object)

    run.__annotations__ = {"outputs": pd.Series, "forms": pd.Series, "return": pd.Series}
    return docs.withColumn(out, F.pandas_udf(run, StringType())(quoted(output), quoted(form)))


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED) -> DataFrame:
    """Per document: its id, code points, form, lengths, and the hashes of the output and of the text rebuilt from it."""

    def one(i: int | None, t: str) -> tuple:
        pieces, form, prefix, middle = divide(i, t, seed)
        return len(t), form, prefix, middle, pieces.sha256(), rebuild(pieces.text(), form).sha256()

    made = docs.select(quoted(doc_id).alias("doc_id"), _per_document(one, DIGESTS, doc_id, text).alias("d"))
    return made.select("doc_id", "d.*")


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))
