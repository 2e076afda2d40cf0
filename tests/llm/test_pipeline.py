"""The pipeline's stages, each against the result of its operator worked out by hand."""

import random

import corpus_pipeline
from edge import ROWS, docs, labels

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def keyed(rows):
    return sorted(tuple(str(r[c]) for c in COLUMNS) for r in rows)


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "secret scans", "best-fit packing"]


def test_run(spark, scratch):
    rng = random.Random(1)
    # words that hardly repeat: with this few labels, a common short word could stand for a label by chance
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(4, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, prose(80), "en", "a", 0) for i in range(200)]
    toxic = set(range(0, 200, 4))
    rows = [(i, f"grob {t} mies grob fies {prose(3)} mies", *rest) if i in toxic else (i, t, *rest) for i, t, *rest in rows]
    rows[1] = (1, rows[5][1].replace(" ", "  "), "en", "a", 0)  # longer, so 5 goes
    rows[2] = (2, rows[3][1] + " tail", "en", "a", 0)
    secret = "0123456789abcdef0123456789abcdef"
    rows[7] = (7, f"{prose(40)} {secret}", "en", "a", 0)
    docs(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    known = spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int")
    known.write.parquet(f"{scratch}/labels.parquet")
    now = spark.read.parquet(f"{scratch}/documents.parquet")
    kept = []
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        now = f(spark, now, scratch)
        if k < 4:
            assert now.columns == COLUMNS
        now.write.parquet(f"{scratch}/{k}")
        now = spark.read.parquet(f"{scratch}/{k}")
        kept.append({r.doc_id for r in now.select("doc_id").distinct().collect()})
    clean = set(range(200)) - toxic
    assert clean <= kept[0] and len(kept[0] & toxic) <= 2
    assert kept[0] - kept[1] == {5}
    assert kept[1] - kept[2] <= {2, 3}
    assert kept[3] == kept[2] == kept[4]
    redacted = spark.read.parquet(f"{scratch}/3").where("doc_id = 7").first()
    assert secret not in redacted.text and redacted.n_chars == len(redacted.text)


def test_awkward_rows_pass_the_stages(spark, scratch):
    labels(spark).write.parquet(f"{scratch}/labels.parquet")
    docs(spark).write.parquet(f"{scratch}/in")
    read = spark.read.parquet(f"{scratch}/in")
    exact = stage("exact dedup")(spark, read, scratch).collect()
    # rows 2 are repeated and equal to 1 but longer; 3, 4, 5 and the null row are all empty, and 5 is the longest
    assert sorted(str(r.doc_id) for r in exact) == sorted(["2", "5", "None", "6", "7", "8", "9", "10"])
    near = stage("SimHash near-dedup")(spark, read, scratch).collect()
    assert {str(r.doc_id) for r in near} >= {"1", "9", "None", "10", "8"}
    assert len([r for r in near if not (r.text or "").split()]) == 1
    secret = stage("secret scans")(spark, read, scratch).collect()
    assert keyed(r for r in secret if r.doc_id != 9) == sorted(
        tuple(str(v) for v in (i, t, lang, source, n if t is None else len(t))) for i, t, lang, source, n in ROWS if i != 9)
    assert len(stage("toxicity")(spark, read, scratch).collect()) <= len(ROWS)


def test_empty_table(spark, scratch):
    docs(spark).limit(0).write.parquet(f"{scratch}/documents.parquet")
    labels(spark).write.parquet(f"{scratch}/labels.parquet")
    assert corpus_pipeline.run(spark, scratch).collect() == []
