import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from llm_fixtures import no_docs, odd_docs  # noqa: F401
from quarry.llm import chunks, token_counts, token_ids
from quarry.llm.queries import tokenizer_path

PATH = tokenizer_path()


def ids(text):
    return chunks.load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab Zé漢1 .,'s\n\t \x1c!?<|>")), max_size=40))
def test_chunks_encode_as_the_whole_text(text):
    assert chunks.ChunkEncoder(PATH, list, lambda v: sum(v, []))(text) == ids(text)


def test_counts_of_odd_documents(odd_docs, no_docs):
    got = token_counts.token_counts(odd_docs, PATH, limit=1024).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(ids(r.text)), len(ids(r.text)) > 1024) for r in odd_docs.collect()]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert token_counts.token_counts(no_docs, PATH).count() == 0


def test_archive_round_trip(odd_docs, no_docs):
    got = {(r.doc_id, r.ids_crc32): r for r in token_ids.token_ids(odd_docs, PATH, shards=3).collect()}
    hashes = {(r.doc_id, r.text): r.h for r in odd_docs.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) h").collect()}
    rows = sorted(odd_docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, hashes[r.doc_id, r.text]))
    start = 0
    for r in rows:
        own = [*ids(r.text), 0]
        g = got[r.doc_id, zlib.crc32(np.array(own, "<u4").tobytes())]
        assert g.n_tokens == len(own)
        if rows.count(r) == 1:
            assert g.start == start
        start += len(own)
    assert token_ids.token_ids(no_docs, PATH).count() == 0


def test_many_lines_without_a_blank(spark):
    texts = ["\n".join(f"{kind}{i}" for i in range(5_000)) for kind in ("w", "", "漢字", "a,b'")]
    texts += ["see " + texts[0] + "\n\n" + texts[1] + " end\n", texts[2] + "\n\t" + texts[3]]
    for t in texts:
        assert chunks.ChunkEncoder(PATH, len, sum)(t) == len(ids(t))
        assert chunks.id_encoder(PATH, "<u4")(t) == np.array(ids(t), "<u4").tobytes()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, PATH).collect()} == {i: len(ids(t)) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in token_ids.token_ids(docs, PATH).collect()} == {i: len(ids(t)) + 1 for i, t in enumerate(texts)}


def test_rows_of_one_id_fill_several_shards(spark):
    docs = spark.createDataFrame([(i % 2 or None, f"text {i}") for i in range(400)], "doc_id long, text string")
    _, manifest = token_ids.write_archive(docs, PATH, shards=8)
    assert sorted(r.n_docs > 0 for r in manifest.collect()).count(True) >= 6
    assert token_ids.token_ids(docs, PATH, shards=8).count() == 400


def test_marks_after_letters_are_looked_up_apart():
    encoder = chunks.ChunkEncoder(PATH, list, lambda v: sum(v, []))
    asked = []

    class Spied:
        def encode(self, text, **kw):
            asked.append(text)
            return encoder.tokenizer.encode(text, **kw)

    encoder.first.tokenizer = encoder.rest.tokenizer = Spied()
    text = " ".join(f"{w}{m}" for m in ("***", "$$$", ".!!", ",%%%") for w in ("amber", "Ünder", "cióncoar", "漢字"))
    assert encoder("x " + text) == ids("x " + text)
    assert sorted(asked) == sorted(["***", "$$$", ".!!", ",%%%"])  # once each; the words by the merges alone


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aZéß漢 \n'*$#!.,_<|>~1s")), max_size=40))
def test_marks_encode_as_the_whole_text(text):
    assert chunks.ChunkEncoder(PATH, list, lambda v: sum(v, []))(text) == ids(text)


def test_the_driver_loads_no_tokenizer(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    chunks.load_tokenizer.cache_clear()
    got = {r.doc_id: r.n_tokens for r in token_ids.token_ids(docs, PATH).collect()}
    assert chunks.load_tokenizer.cache_info().misses == 0  # the tasks run in other processes
    assert got == {1: len(ids("some text")) + 1, 2: 1}
