"""Language references of the quality rules: whose texts they are made of."""

import random

from test_llm_truth import twin
from tidemark.llm import quality_rules, queries

SCHEMA = "doc_id long, text string, lang string, source string"


def sentence(rng, n=120):
    lists = quality_rules.COMMON["en"].split()
    return " ".join(rng.choice(lists) if rng.random() < 0.5 else "".join(rng.choices("aeinorst", k=rng.randrange(3, 9))) for _ in range(n))


def junk(rng, n=200):
    return " ".join("".join(rng.choices("QXZ0189", k=rng.randrange(4, 12))) for _ in range(n))


def verdicts(spark, rows):
    return {r.doc_id: r.out for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA), "out").collect()}


def test_a_text_is_not_its_own_reference(spark, folder):
    rng = random.Random(1)
    rows = [(k, sentence(rng), "en", "web") for k in range(60)]
    rows += [(100 + k, junk(rng), f"x{k}", "web") for k in range(5)]  # each the only text of its language
    rows += [(200, sentence(rng), "rare", "web"), (201, sentence(rng), None, None), (202, None, "en", "web"), (203, "", "y", None)]
    got = verdicts(spark, rows)
    assert all(got[k].kept for k in [*range(60), 200, 201])
    assert not any(got[k].kept or got[k].base_failed for k in range(100, 105))
    assert twin(spark, folder(), {"documents": spark.createDataFrame(rows, SCHEMA)}, queries.QUERIES["op1_quality_rules"], queries.ORACLE["op1_quality_rules"]) is None


def test_copies_and_long_texts_do_not_rule_a_reference(spark, folder):
    rng = random.Random(2)
    rows = [(k, sentence(rng), "en", "web") for k in range(60)]
    copy, long = junk(rng), junk(rng, 60_000)
    rows += [(1000 + k, copy, "en", "hot") for k in range(2000)] + [(5000, long, "en", "hot")]
    got = verdicts(spark, rows)
    assert all(got[k].kept for k in range(60))
    assert not any(v.kept for k, v in got.items() if k >= 1000)
    small = [r for r in rows if r[0] != 5000 and r[0] < 1100]
    assert twin(spark, folder(), {"documents": spark.createDataFrame(small, SCHEMA)}, queries.QUERIES["op1_quality_rules"], queries.ORACLE["op1_quality_rules"]) is None


def test_a_text_alone_has_no_reference(spark):
    rng = random.Random(3)
    text = sentence(rng)
    got = verdicts(spark, [(1, text, "en", None), (2, text, "en", None)])
    assert all(v.js_chars is None and v.js_words is None and v.kept for v in got.values())
