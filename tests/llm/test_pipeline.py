import corpus_pipeline
import __spark_entry__
from plumbline.llm import crf_quality, decontaminate, packing, simhash
from plumbline.llm.queries import vocabulary
from tests.llm.test_near_duplicates import plain_components, plain_fingerprint
from tests.llm.test_text_operators import plain_dedup

FOLDER = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    queries = __spark_entry__.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in queries) == 1 for n in range(1, 14))
    assert "pipeline" in queries and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_against_brute_force(spark):
    """Each stage on its own input, which is what the stage before it returned."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    results = []
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        rows = out.collect()
        results.append(([r.asDict() for r in docs.collect()], [r.asDict() for r in rows], out.columns))
        docs = spark.createDataFrame(rows, out.schema)
    assert all(c == columns for _, _, c in results[:-1])
    (before, after, _) = results[0]
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = crf_quality.train(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)
    assert [r["doc_id"] for r in after] == [r["doc_id"] for r in before if model.scores([r["text"] or ""])[0] >= 0.3]
    (before, after, _) = results[1]
    texts = plain_dedup([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after} == {d: (t, len(t)) for d, t in texts.items()}
    (before, after, _) = results[2]
    before.sort(key=lambda r: r["doc_id"])
    kept = {before[k]["doc_id"] for k in plain_components([plain_fingerprint(r["text"]) for r in before])}
    assert {r["doc_id"] for r in after} == kept and len(after) == len(kept)
    (before, after, _) = results[3]
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {r["doc_id"] for r in before if not any(decontaminate.normal(i) in decontaminate.normal(r["text"]) for i in items)}
    assert {r["doc_id"] for r in after} == clean
    (before, after, _) = results[4]
    counts = {}
    for r in after:
        counts[r["length"]] = counts.get(r["length"], 0) + 1
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    assert len({r["sequence_id"] for r in after}) == sum(packing.complete_bins(counts, 1024).values())
    assert simhash and vocabulary


def test_run_is_the_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))
