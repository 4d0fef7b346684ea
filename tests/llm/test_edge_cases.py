"""Every operator on nulls, empty, blank and long texts, ties, repeated rows, an empty table and clashing names."""

import hashlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from colloquy.llm import common, content_sort, fertility, html_blocks, lengths, pareto_mix, partition_join, piece_bpe, redirects, span_crf, toxicity
from colloquy.llm.queries import BYTE_BPE, BYTE_BPE_MULTI, PATTERN, PIECES, RULES
from tests.llm.helpers import awkward, awkward_rows, empty
from tests.llm.test_partition_join import naive

TOXIC = [(i, "you idiot" if i % 2 else "a kind word", "en", "a", 9) for i in range(100, 140)]


def labelled(spark):
    return spark.createDataFrame([(row[0], i % 2) for i, row in enumerate(TOXIC)], "doc_id long, toxic int")


def encode(docs):
    return piece_bpe.decode(piece_bpe.encode(docs, BYTE_BPE, PATTERN), BYTE_BPE, PATTERN)


def test_one_pass_gives_what_two_give(spark):
    both = piece_bpe.round_trip(awkward(spark), BYTE_BPE, PATTERN)
    apart = encode(awkward(spark))
    assert both.columns == apart.columns
    assert sorted(map(repr, both.collect())) == sorted(map(repr, apart.collect()))


OPERATORS = {
    "fertility": (lambda d: fertility.judge(d, PIECES, BYTE_BPE_MULTI, PATTERN), "kept"),
    "pareto_mix": (pareto_mix.mix, "taken"),
    "content_sort": (content_sort.mark_duplicates, "kept"),
    "partition_join": (partition_join.components, "component_id"),
    "piece_bpe": (encode, "ids"),
    "span_crf": (span_crf.find, "spans"),
    "toxicity": (lambda d: toxicity.score(d, labelled(d.sparkSession)), "score"),
    "lengths": (lambda d: lengths.with_length(d, BYTE_BPE, PATTERN), "n_tokens"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows_each_get_one_result(spark, name):
    operator, column = OPERATORS[name]
    docs = awkward(spark)
    rows = operator(docs).collect()
    assert sorted(map(repr, (r["doc_id"] for r in rows))) == sorted(repr(r[0]) for r in awkward_rows())
    if name != "partition_join":
        assert all(r[column] is not None for r in rows)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name][0](empty(spark)).count() == 0


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "partition_join"])
def test_clashing_columns_are_replaced_and_others_kept(spark, name):
    operator, column = OPERATORS[name]
    docs = awkward(spark).withColumn(column.upper(), F.lit("old")).withColumn("_run", F.lit(1)).withColumn("my column", F.lit(2))
    got = operator(docs)
    assert [c.lower() for c in got.columns].count(column) == 1
    assert {"_run", "my column"} <= set(got.columns)
    assert got.select(column).distinct().count() > 0


def test_values_of_awkward_rows(spark):
    docs = awkward(spark)
    judged = {(r.doc_id): r for r in fertility.judge(docs, PIECES, BYTE_BPE_MULTI, PATTERN).collect()}
    assert judged[0].n_dup_lines == 1 and judged[0].n_words == 14
    assert judged[1].base_failed and not judged[1].kept and judged[1].chars_per_token is None
    assert judged[4].n_words == 24000 and judged[4].n_repeat_words == 24000
    marked = content_sort.mark_duplicates(docs, keep="largest").collect()
    by = {(r.doc_id): r for r in marked}
    assert (by[1].keep_id, by[1].group_size, by[2].kept) == (2, 2, True)
    assert (by[4].keep_id, by[5].kept, by[None].keep_id) == (5, True, 7)
    assert sum(r.kept for r in marked if r.doc_id == 6) == 1
    assert by[1].text_sha256 == hashlib.sha256(b"").hexdigest()
    component = {r.doc_id: (r.n_shingles, r.component_id) for r in partition_join.components(docs).collect()}
    assert component[5] == (4, 4) and component[1] == (0, 1) and component[None] == (1, 7)
    mixed = {r.doc_id: r for r in pareto_mix.mix(docs).collect()}
    assert mixed[1].size == mixed[1].taken == 0
    assert all(0 <= r.taken <= 3 * r.size for r in mixed.values())


def test_pages(spark):
    pages = spark.createDataFrame(
        [(1, None, None, "x"), (2, "no scheme", "", "x"), (3, "http://A.example.COM/en/1?q#f", "<p>unclosed & <b>bold", "x"), (3, "http://A.example.COM/en/1?q#f", "<p>unclosed & <b>bold", "x")],
        "page_id long, url string, html string, verdict string",
    )
    rows = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in redirects.judge(pages, RULES).fillna("").collect())
    assert rows == [(1, "", "", "", "allow"), (2, "", "", "", "allow"), *[(3, "a.example.com", "/en/1", "example.com/en/", "block")] * 2]
    assert redirects.judge(pages.limit(0), RULES).count() == 0
    extracted = html_blocks.extract(pages.withColumn("text", F.lit(0)))
    assert sorted(r.text for r in extracted.collect())[:2] == ["", ""]
    assert html_blocks.extract(pages.limit(0)).count() == 0


def test_pipeline_of_awkward_rows(spark, tmp_path):
    docs = awkward(spark).union(spark.createDataFrame(TOXIC, awkward(spark).schema)).withColumn("extra", F.lit(1))
    labelled(spark).write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()

    # The rows that each stage leaves, worked out one by one.
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    judged = toxicity.score(read.select("doc_id", "text", "source"), labelled(spark), keep_text=True).filter("predicted = 0").collect()
    first = {}
    for row in sorted(judged, key=lambda r: (r.doc_id is None, r.doc_id or 0)):
        first.setdefault((row.text or "").encode().lower(), row)
    left = list(first.values())
    stays = [left[i] for i, _, root in naive([r.text or "" for r in left]) if i == root]
    named = [(r.doc_id, r.text, r.source) for r in stays]
    mixed = pareto_mix.mix(spark.createDataFrame(named, "doc_id long, text string, source string")).collect()
    copies = [r.doc_id for r in mixed for _ in range(r.copies)]
    assert 5 < len(copies) < 60 and {4, 6, 8, 9} <= set(copies)
    assert sorted(map(repr, (r.doc_id for r in done))) == sorted(map(repr, copies))
    empty_dir = tmp_path / "none"
    docs.limit(0).write.parquet(str(empty_dir / "documents.parquet"))
    labelled(spark).limit(0).write.parquet(str(empty_dir / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(empty_dir)).count() == 0


def test_workers_give_back_what_arrow_keeps(monkeypatch):
    """At the end of a task, and when it is ended before its last batch."""
    calls = []
    monkeypatch.setattr(common.pa, "default_memory_pool", lambda: type("Pool", (), {"release_unused": lambda self: calls.append(1)})())
    batches = [pa.RecordBatch.from_pydict({"x": [i]}) for i in range(3)]
    assert list(common.released(lambda rows: rows)(iter(batches))) == batches and calls == [1]
    ended = common.released(lambda rows: rows)(iter(batches))
    assert next(ended) == batches[0] and calls == [1]
    ended.close()
    assert calls == [1, 1]
