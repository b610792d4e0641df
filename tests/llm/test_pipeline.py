"""The stages one after another, against their operators' own results."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from retention.llm import mixing, quality, simhash
from test_operators import kept_texts

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "suffix_dedup", "mix", "bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, SF).cache()
    chain = quality.train_chain(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in quality.judge_documents(docs, chain).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns
    one = corpus_pipeline.near_dedup(spark, kept, SF).cache()
    groups = simhash.near_duplicates(kept).collect()
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in groups}
    cut = corpus_pipeline.suffix_dedup(spark, one, SF).cache()
    assert cut.columns == docs.columns and all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = corpus_pipeline.mix(spark, cut, SF)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {r.doc_id for r in cut.collect()}
    assert corpus_pipeline.run(spark, SF).count() == cut.count()


def test_mixed_order_is_kept(spark, tmp_path):
    sources = {"a": 700, "b": 200, "c": 100}
    rows = [(i, f"{s} {i} " + "x" * 300, s) for s, n in sources.items() for i in range(n)]
    rows = [(k, *r[1:]) for k, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    mixed = mixing.mix_documents(docs, weights, block_bytes=1, period=100)      # a document a block
    place = {r.doc_id: r.position for r in mixed.collect()}
    mixing.in_mixed_order(docs, mixed).write.parquet(str(tmp_path / "mixed"))
    got = sorted(corpus_pipeline.bpe(spark, spark.read.parquet(str(tmp_path / "mixed")), SF).collect(), key=lambda r: r.position)
    assert [r.position for r in got] == list(range(1000)) and {r.doc_id: r.position for r in got} == place
    # the final order keeps every source within one block of its weight while none has run out
    mixed = mixing.mix_documents(docs, weights, block_bytes=310, period=100).toPandas().set_index("doc_id")
    mixing.in_mixed_order(docs, mixing.mix_documents(docs, weights, block_bytes=310, period=100)).write.parquet(str(tmp_path / "again"))
    got = sorted(corpus_pipeline.bpe(spark, spark.read.parquet(str(tmp_path / "again")), SF).collect(), key=lambda r: r.position)
    size, served = mixed["size"].to_dict(), dict.fromkeys(weights, 0)
    for r in got[:480]:
        served[rows[r.doc_id][2]] += size[r.doc_id]
        total = sum(served.values())
        assert all(abs(served[s] - w * total) <= 2 * 310 + 0.02 * total for s, w in weights.items())    # parts are rounded


def test_run_writes_the_ids(spark):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.position for r in got) == list(range(len(got)))
    assert all(hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256 and len(r.ids) == r.n_tokens for r in got)
    assert sum(r.n_tokens for r in got) > 10 * len(got)


ODD = ("doc_id long, text string, lang string, source string, n_chars long, position long, _row long, kept string, root long, ids string, "
       "_file string, size long")


def odd_table(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with the names that operators use."""
    rnd = random.Random(12)
    words = [f"word{i}" for i in range(400)]
    prose = lambda n: " ".join(rnd.choice(words) + rnd.choice(["", "", "", ".", ","]) for _ in range(n))
    passage, copy, long = prose(40), prose(90), prose(20_000)
    texts = [(1, None), (2, ""), (3, "  \n"), (4, prose(60)), (4, prose(60)), (5, copy), (5, copy), (6, copy), (None, copy), (None, None), (None, prose(50)),
             (7, long), (8, prose(50) + passage + prose(50)), (9, prose(80) + "\n" + passage), (10, "same word " * 400), (11, "naïve 日本 " * 40 + prose(40))]
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"src{k % 2}", None if k % 5 == 0 else len(t or ""), 7, 7, "x", 7, "x", "x", 7)
            for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, ODD).repartition(3)


def test_stages_on_odd_rows(spark, tmp_path):
    """Each stage on what the one before it kept, against the operators' rules by hand."""
    docs = odd_table(spark)
    seen = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        assert name == "bpe" or out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"{k}"))
        docs = spark.read.parquet(str(tmp_path / f"{k}"))
        seen[name] = docs.collect()
    base = Counter((r.doc_id, r.text) for r in odd_table(spark).collect())
    kept = Counter((r.doc_id, r.text) for r in seen["quality_rules"])
    assert kept <= base and all(t and len(t.split()) >= 20 for _, t in kept) and not any(t.startswith("same word") for _, t in kept)
    # a group of copies keeps its smallest id, once; others stay
    one = Counter((r.doc_id, r.text) for r in seen["near_dedup"])
    assert one <= kept and max(Counter(t for _, t in one).values()) == 1 and {t for _, t in one} == {t for _, t in kept}
    left = {i: t for i, t in one if i == 5}
    assert left or not any(i == 5 for i, _ in kept)
    cut = {(r.doc_id, r.text): r.n_chars for r in seen["suffix_dedup"]}
    assert len(cut) == len(one) and all(n == len(t) for (_, t), n in cut.items())
    order = sorted(one, key=lambda r: (r[0] is None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))
    assert set(cut) == set(zip([i for i, _ in order], kept_texts([t for _, t in order])))
    assert Counter(seen["mix"]) == Counter(seen["suffix_dedup"])
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, tuple(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in seen["mix"])
    assert Counter((r.doc_id, tuple(r.ids)) for r in seen["bpe"]) == want
    assert sorted(r.position for r in seen["bpe"]) == list(range(len(seen["mix"])))


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
