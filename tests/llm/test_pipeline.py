import corpus_pipeline
from rowferry.llm.common import components
from rowferry.llm.queries import QUERIES
from rowferry.llm.suffix_dedup import remove_repeats
from tests.llm.data import documents, empty, in_many_files, labels, other_splits

SF_DIR = "/root/testdata/sf0.001"


def one_of_each_group(df):
    """The smallest ids of groups of texts with a Jaccard similarity of 0.8 over 5-word shingles, by all pairs."""
    sets = {}
    for r in df.select("doc_id", "text").collect():
        words = (r["text"] or "").encode().lower().split()
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    kept, root = sorted(sets), {i: i for i in sets}
    for b in kept:
        for a in (x for x in kept if x < b):
            union = len(sets[a] | sets[b])
            if not union or len(sets[a] & sets[b]) / union >= 0.8:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return sorted(set(root.values()))


def test_splits_may_change_between_passes(spark, tmp_path):
    docs = in_many_files(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), str(tmp_path / "t"))
    with other_splits(spark, 3):
        kept = corpus_pipeline.near_copies(spark, docs, SF_DIR)
        cut = corpus_pipeline.repeats(spark, docs, SF_DIR)
    with other_splits(spark, 40):
        assert sorted(r["doc_id"] for r in kept.collect()) == one_of_each_group(docs)
        found = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert found == {r["doc_id"]: r["text"] for r in corpus_pipeline.repeats(spark, docs, SF_DIR).collect()}


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))


def test_stages(spark):
    """Every stage works on all that the one before kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rules = QUERIES["op7_quality_rules"](spark, SF_DIR)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        if name != "pieces":
            assert docs.columns == before.columns
        ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
        if name == "quality rules":
            assert ids(docs) == ids(rules.filter("kept"))
        elif name == "near copies":
            assert ids(docs) == one_of_each_group(before) and len(ids(docs)) < len(ids(before))
        elif name == "repeats":
            cut = {r["doc_id"]: r["n_removed"] for r in remove_repeats(before).collect()}
            old = {r["doc_id"]: r["text"] for r in before.collect()}
            assert any(cut.values()) and ids(docs) == ids(before)
            for r in docs.collect():
                lost = len(old[r["doc_id"]].encode()) - len(r["text"].encode())
                assert cut[r["doc_id"]] <= lost <= cut[r["doc_id"]] * 1.1 + 8 if cut[r["doc_id"]] else lost == 0
        elif name == "source mix":
            words = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
            assert abs(words(docs) / words(before) - 1.5) < 0.1
        else:
            assert all(len(r["piece_ids"]) > 0 or not r["text"] for r in docs.collect())


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).filter("size(piece_ids) > 0").count() > 0


def test_awkward_rows(spark, tmp_path):
    for i, docs in enumerate((documents(spark), empty(spark))):
        folder = str(tmp_path / str(i))
        docs.write.parquet(f"{folder}/documents.parquet")
        labels(spark, [(5, 0, 0), (None, 1, 1)]).write.parquet(f"{folder}/labels.parquet")
        assert corpus_pipeline.run(spark, folder).count() >= 0


def test_one_of_repeated_rows_stays(spark):
    rows = [(1, "a b c d", "en", "s", 7)] * 3 + [(None, "a b c d", "en", "s", 7), (1, "z y x w v", "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_copies(spark, docs, SF_DIR).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, "a b c d"), (1, "z y x w v")]


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 5), (9, 7), (7, 9), (None, 3), (200, 130)]
    df = spark.createDataFrame(chain, "a long, b long")
    found = {r["node"]: r["root"] for r in components(df).collect()}
    assert found == {**{i: 100 for i in [*range(100, 161), 200]}, 7: 7, 9: 7}
