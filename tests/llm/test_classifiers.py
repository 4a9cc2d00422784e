import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratelake.llm import language_id, quality, toxicity
from ratelake.llm.shared import crc_fold

from .conftest import by_id

LABELS = "doc_id long, quality int, toxic int"


def noise(draw, n=30):
    return " ".join("".join(draw.choice("abdeilnorst") for _ in range(draw.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def marked(spark):
    """600 texts: toxic ones have one of three words or a word beginning, junk ones repeat words."""
    draw, rows, labels = random.Random(4), [], []
    for i in range(600):
        text, toxic, good = noise(draw), i % 6 == 0, i % 5 != 0
        if toxic:
            word = draw.choice(["vileword", "grimthing", "foulname", "krassu" + draw.choice(["en", "um", "ax", "ig"])])
            text = f"{text} {word} {noise(draw, 20)}"
        elif i % 70 == 1:
            text = f"{text} not vileword {noise(draw, 5)}"
        if not good:
            text = " ".join(w for w in text.split() for _ in range(6))
        rows.append((i, text))
        labels.append((i, int(good), int(toxic)))
    labels += [(9_000, 1, 0), (None, 1, 1), (1, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(1.0)).withColumn("label", F.lit(3))
    return docs, spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t in labels[:600]}


def accuracy(got, truth, at):
    held = [(p, truth[i][at]) for i, (h, p) in got.items() if h and i in truth]
    assert len(held) > 60
    return np.mean([a == b for a, b in held])


def test_toxicity_on_held_out_rows(marked):
    docs, labels, truth = marked
    lexicon = toxicity.train(docs, labels)
    assert any("vileword" in e for e in lexicon.exceptions)
    got = by_id(toxicity.toxicity_scores(docs, lexicon), "held_out", "predicted")
    assert accuracy(got, truth, 1) > 0.97
    kept = {r.doc_id for r in toxicity.keep_clean(docs, lexicon).collect()}
    assert kept == {i for i, (_, p) in got.items() if p == 0}
    assert toxicity.keep_clean(docs, lexicon).columns == docs.columns
    clashing = docs.withColumns({c: F.lit(1.0) for c in ("evidence", "strongest", "predicted", "held_out")})
    assert {r.doc_id for r in toxicity.keep_clean(clashing, lexicon).collect()} == kept


def test_toxicity_folds_disguises(documents):
    lexicon = toxicity.Lexicon({" vile ": 5.0, " krass": 5.0}, [" not vile "], (-3.0, 1.0, 1.0))
    bad = ["a vile b", "V1LE", "νіlе", "v​ile", "vilé!", "xx Krassest", "v!le", "b vile not vile", "vile " + "a " * 300_000]
    good = [None, "", " ", "not vile", "so not   VILE.", "revile", "viles", "123", "vile" * 3]
    rows = [(i, t) for i, t in enumerate(bad + good)]
    got = by_id(toxicity.toxicity_scores(documents(*rows, (None, "vile")), lexicon), "score", "predicted")
    assert [i for i, (_, p) in got.items() if p and i is not None] == list(range(len(bad)))
    assert all(0 <= s <= 1 for s, _ in got.values()) and got[None][1] == 1


def test_no_labels_and_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    docs = documents((1, "a b"), (2, None), (None, "c"))
    assert [r.predicted for r in toxicity.toxicity_scores(docs, toxicity.train(docs, none)).collect()] == [0, 0, 0]
    assert {r.score for r in quality.quality_scores(docs, quality.train(docs, none)).collect()} == {0.5}
    empty = docs.limit(0)
    assert toxicity.toxicity_scores(empty, toxicity.train(empty, none)).count() == 0
    assert quality.quality_scores(empty, quality.train(empty, none)).count() == 0
    assert language_id.languages(empty, language_id.train(empty)).count() == 0


def test_quality_on_held_out_rows(marked):
    docs, labels, truth = marked
    model = quality.train(docs, labels)
    got = by_id(quality.quality_scores(docs, model), "held_out", "predicted")
    assert accuracy(got, truth, 0) > 0.97


def test_quality_scores_do_not_depend_on_neighbours():
    model = quality.QualityModel(np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    texts = ["a b c c", None, "", "é", "x" * 3_000_000 + " y", "word word", "a"]
    every = model.score(pa.array(texts))
    assert np.allclose(every, [model.score(pa.array([t], pa.string()))[0] for t in texts])
    assert every[1] == every[2] == pytest.approx(1 / (1 + np.exp(-0.3)))


def test_language_on_held_out_rows(spark):
    draw, rows = random.Random(2), []
    for i in range(400):
        lang = ["xa", "yb", None, "zc"][i % 4]
        stems = {"xa": ["ung", "sch", "der"], "yb": ["eau", "ré", "les"], "zc": ["ción", "que", "los"], None: ["eau", "ré", "les"]}[lang]
        rows.append((i, " ".join("".join(draw.choice(stems) for _ in range(2)) for _ in range(draw.randint(3, 25))), lang))
    rows += [(1000, None, "xa"), (1001, "", "xa"), (1002, "12 34 !", "yb"), (1003, "ung " * 200_000, None), (None, "ción que", "zc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("value", F.lit(1)).withColumn("found", F.lit("x"))
    got = by_id(language_id.languages(docs, language_id.train(docs)), "held_out", "lang_pred", "score")
    truth = {r[0]: r[2] for r in rows}
    held = [(got[i][1], truth[i]) for i in range(400) if got[i][0] and truth[i]]
    assert np.mean([a == b for a, b in held]) > 0.98
    assert all(got[i][1:] == ("und", 0.0) for i in (1000, 1001, 1002)) and got[1003][1] == "xa" and got[None][1] == "zc"
    assert all(0 <= s <= 1 for _, _, s in got.values())
    folds = by_id(docs.select("doc_id", (crc_fold("doc_id", 3) == 1).alias("f")), "f")
    assert all(got[i][0] == folds[i][0] for i in folds)
