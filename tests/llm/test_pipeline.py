import corpus_pipeline
from scoremill.llm.exact_dedup import exact_duplicates
from scoremill.llm.near_dedup import near_duplicates
from scoremill_checks.compare import duck

from .test_near_dedup import brute as near
from .test_packing import check
from .test_quality import base

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark):
    docs, held = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select(*COLUMNS).collect()]
        out = function(spark, docs, SF)
        rows = [tuple(r) for r in out.collect()]
        held[name] = before, rows
        if name == "packing":
            break
        assert out.columns == COLUMNS and set(rows) <= set(before)
        docs = spark.createDataFrame(rows, docs.schema)
    before, rows = held["quality"]
    assert not any(base(r[1])[5] for r in rows)
    before, rows = held["exact_dedup"]
    last = {}
    for r in sorted(before):
        last["".join(c.lower() if c.isascii() else c for c in r[1])] = r
    assert sorted(rows) == sorted(last.values())
    before, rows = held["near_dedup"]
    kept = {x.split(",")[0][1:] for x in near([r[:2] for r in before]) if x.endswith("True)")}
    assert {str(r[0]) for r in rows} == kept
    before, rows = held["packing"]
    assert check(rows, [r[:2] for r in before], 1024) < 0.05


def test_awkward_documents(spark, awkward, empty):
    columns = [c for c in awkward.columns]
    for docs in (awkward, empty):
        for name, function in corpus_pipeline.STAGES:
            out = function(spark, docs, SF)
            assert out.count() >= 0
            if name != "packing":
                assert out.columns == (columns if docs is awkward else empty.columns)


def test_dropped_labels_do_not_matter(spark):
    assert exact_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).count() == duck(SF).execute(
        "SELECT count(*) FROM documents").fetchone()[0] == near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).count()


def test_one_row_of_each_group_stays_with_repeated_and_null_identifiers(spark):
    a, b, c, d = (" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcd")
    rows = [(1, a), (1, b), (2, a), (3, c), (3, c), (None, d), (None, d.upper()), (None, "alone"), (4, None), (None, None)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    got = [tuple(r)[:2] for r in corpus_pipeline.exact_stage(spark, docs, SF).collect()]
    assert sorted(got, key=str)[:4] == [(1, b), (2, a), (3, c), (4, None)]
    assert sorted((t or "").lower() for i, t in got if i is None) == sorted([d, "alone"]) and len(got) == 6

    rows = [(1, a), (1, b), (0, a + " x"), (3, c), (3, c + " x"), (None, d), (None, d + " x"), (None, c + " y"), (None, None),
            (None, ""), (7, "")]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    got = [tuple(r)[:2] for r in corpus_pipeline.near_stage(spark, docs, SF).collect()]
    assert sorted(i for i, t in got if i is not None) == [0, 1, 3, 7] and (0, a + " x") in got and (1, b) in got
    assert sorted((t or "")[:2] for i, t in got if i is None) == ["", "", "d0"]
