import corpus_pipeline
import __spark_entry__ as entry
from episodic.llm import langid, minhash, mixing, secrets
from llm.helpers import SMALL, clashing, documents, edge_rows, frame, pandas


def test_registered():
    names = sorted(entry.LLM_QUERIES)
    assert "pipeline" in names and {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_dedup", "secret_scan", "source_mix", "bpe_encode"]


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one = langid.keep_known_languages(docs)
    assert one.count() == docs.count()                       # these documents are all in known languages
    kept = pandas(minhash.near_duplicates(docs))
    keep = set(kept.index[kept.kept])
    two = docs.where(docs.doc_id.isin([int(i) for i in keep]))
    model = secrets.infer(two.select("text"))
    clean = {int(i): secrets.redact(model, t) for i, t in documents().text.items() if i in keep}
    three = frame(spark, [(i, t, None, documents().source[i], len(t)) for i, t in clean.items()])
    plan = pandas(mixing.mix_documents(three))
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == plan.copies[plan.copies > 0].to_dict()


def test_stages_on_edge_cases(spark):
    rows = edge_rows() + [(i, "the and that with from this have which are but " + f"number{i} " * 5, "en", "a", 9) for i in range(100, 140)] \
        + [(i, "le la les des une est dans pour que " + f"nombre{i} " * 5, "fr", "a", 9) for i in range(200, 240)]
    docs = clashing(frame(spark, rows))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r["doc_id"], r["text"]): r for r in docs.collect()}
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns, name
        # the caller's own columns keep their values
        own = [c for c in columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
        assert all(r[c] == "x" for r in docs.collect() for c in own), (name, len(before))
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() == docs.count() > 0
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_dedup_keeps_the_least_of_rows_that_differ_elsewhere(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, "en", "B", 1), (1, text, "en", "A", 2), (1, text, "en", "A", 1), (2, text, "en", "A", 0), (3, "other words", "en", "z", 1),
            (3, "other words", None, "z", 1), (3, "a third text", "en", "a", 1), (None, text, "en", "a", 1), (None, text, "en", "a", 1)]
    for n in (1, 5):
        out = sorted((tuple(r) for r in minhash.one_per_class(frame(spark, rows).repartition(n)).collect()), key=str)
        assert out == sorted([(1, text, "en", "A", 1), (3, "other words", None, "z", 1), (3, "a third text", "en", "a", 1),
                              (None, text, "en", "a", 1), (None, text, "en", "a", 1)], key=str)
