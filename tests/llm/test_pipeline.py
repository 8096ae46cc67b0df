import re

import pyarrow as pa

import corpus_pipeline
from tablewright.llm import decontaminate, language, pieces, secret_scan

from .test_similarity import brute_components

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_loops(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = [r.asDict() for r in docs.collect()]
    junk = [dict(rows[0], doc_id=10**6 + k, text=t) for k, t in enumerate(("", None, "12 34 --", "\n"))]
    state = spark.createDataFrame(rows + junk, docs.schema)

    # Languages: exactly the rows of no language go.
    model = language.train(state)
    kept = corpus_pipeline.keep_known_languages(spark, state, SF)
    assert kept.columns == columns
    shares = {r["doc_id"]: model.shares(pa.array([r["text"]]))[0].max() for r in rows}
    want = {i for i, s in shares.items() if s >= corpus_pipeline.LEAST_LANGUAGE_SCORE}
    rows = [r for r in rows if r["doc_id"] in want]
    assert {r["doc_id"] for r in kept.collect()} == want and len(want) > 195

    groups = brute_components([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if groups[r["doc_id"]][1] == r["doc_id"]]
    kept = corpus_pipeline.keep_one_of_each(spark, kept, SF)
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows}

    items = [decontaminate.normalize(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        text = decontaminate.normalize(text)
        return any(decontaminate.nearest_end(decontaminate.masks_of(i), len(i), text)[0] <= int(0.05 * len(i)) for i in items)

    clean = {r["doc_id"] for r in rows if not leaks(r["text"])}
    kept = corpus_pipeline.drop_leaks(spark, kept, SF)
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == clean
    rows = [r for r in rows if r["doc_id"] in clean]

    secrets = secret_scan.train(kept)
    masked = {r["doc_id"]: r for r in corpus_pipeline.mask_secrets(spark, kept, SF).collect()}
    assert set(masked) == clean
    for r in rows:
        found = next(secret_scan._found(pa.array([r["text"]]), secrets))[1]
        assert (masked[r["doc_id"]]["text"] == r["text"]) == (not found)
        assert masked[r["doc_id"]]["n_chars"] == len(masked[r["doc_id"]]["text"])
        assert not re.search(r"(?i)(token|secret|password) ?= ?.?[a-z0-9]{8}", masked[r["doc_id"]]["text"])


def test_run_keeps_columns_and_decodes(spark):
    done = corpus_pipeline.run(spark, SF)
    assert done.columns[:-1] == spark.read.parquet(f"{SF}/documents.parquet").columns and done.columns[-1] == "ids"
    for r in pieces.decode_pieces(done).collect():
        assert r["decoded"] == r["text"]


def test_empty_tables_pass(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_odd_rows_and_clashing_columns_pass_through_all_stages(spark, odd_docs, tmp_path):
    """NULLs, repeated rows, long and empty texts, and columns of the names that stages use for themselves."""
    base = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").limit(40).collect()]
    names = odd_docs.columns
    extra = {c: c for c in names if c not in ("doc_id", "text", "lang", "n_chars")}
    rows = [{**extra, "doc_id": 1000 + k, "text": t, "lang": "en", "n_chars": len(t)} for k, t in enumerate(base)]
    rows += [{**rows[0], "doc_id": None}, {**rows[1]}, {**rows[2], "text": rows[2]["text"] + " token=abcdefgh12345678", "doc_id": 2000}]
    docs = odd_docs.unionByName(spark.createDataFrame([tuple(r[c] for c in names) for r in rows], odd_docs.schema))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    done = corpus_pipeline.run(spark, str(tmp_path))
    assert done.columns == [c for c in names if c != "ids"] + ["ids"]
    found = done.collect()
    assert all(r[c] == c for r in found for c in extra if c != "ids") and len(found) > 20
    assert not any(r["text"] is None or "token=abcdefgh12345678" in r["text"] for r in found)
    assert sum(r["doc_id"] is None for r in found) >= 1 and len({r["doc_id"] for r in found} - {None}) > 20
