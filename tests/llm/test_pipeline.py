"""The corpus pipeline, stage by stage, against brute force on a small table."""

import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from quarry.llm import chunks, mixing, token_ids, toxicity
from quarry.llm.common import table
from quarry.llm.queries import tokenizer_path
from quarry.session import materialize

from conftest import SF_SMALL
from test_sets import UP, brute_components
from test_text_models import naive_clauses


@pytest.fixture(scope="module")
def stages(spark):
    """{stage: (input rows, output rows)} of one run."""
    docs, out = table(spark, SF_SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = materialize(stage(spark, docs, SF_SMALL), f"test-{name}")
        out[name] = docs.collect(), done.collect(), docs.columns, done.columns
        docs = done
    return out


def test_stages_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "token_ids"]
    for name, (_, _, before, after) in list(stages.items())[:-1]:
        assert before == after
    assert all(len(got) > 0 for _, got, _, _ in stages.values())


def test_toxic_documents_go(spark, stages):
    docs, got, _, _ = stages["toxicity"]
    model = toxicity.train(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    x = []
    for d in docs:
        text = d.text or ""
        scores, n = naive_clauses(model.lexicon, text), len(toxicity._TOKEN.findall(text.lower()))
        total = sum(scores)
        x.append([np.log1p(total), max(scores, default=0.0), np.log1p(len(scores)), np.log1p(1000 * total / n) if n else 0.0, np.log1p(n)])
    kept = [d.doc_id for d, p in zip(docs, model.probability(np.array(x))) if p < 0.3]
    assert sorted(kept) == sorted(r.doc_id for r in got) and len(kept) < len(docs)


def test_one_of_each_group_stays(stages):
    docs, got, _, _ = stages["ngram_jaccard_join"]
    found = [eval(r) for r in brute_components([(d.doc_id, d.text) for d in docs])]  # noqa: S307  own tuples
    kept = sorted(d for d, n, component in found if not n or d == component)
    assert kept == sorted(r.doc_id for r in got) and len(kept) < len(docs)


def test_documents_with_benchmark_windows_go(spark, stages):
    docs, got, _, _ = stages["benchmark_decontamination"]

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(UP))

    windows = set()
    for item in table(spark, SF_SMALL, "benchmark").collect():
        w = words(item.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    kept = []
    for d in docs:
        w = words(d.text)
        if not any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1)):
            kept.append(d.doc_id)
    assert sorted(kept) == sorted(r.doc_id for r in got) and len(kept) < len(docs)


def test_the_draw_follows_the_raked_weights(stages):
    docs, got, _, _ = stages["mixing"]

    def cell(d):
        t = d.text or ""
        kind = ("legal" if "License" in t or "Copyright" in t else "table" if " | " in t else "contact" if "@" in t
                else "shout" if "!!" in t else "prose")
        return d.source or "(none)", d.lang or "(none)", kind

    tokens = {}
    for d in docs:
        tokens[cell(d)] = tokens.get(cell(d), 0) + (len(d.text.split(" ")) if d.text else 0)
    cells = [c for c, n in tokens.items() if n]
    w, targets = {c: float(tokens[c]) for c in cells}, []
    for i, dim in enumerate(mixing.DIMS):
        sums = {}
        for c, n in tokens.items():
            sums[c[i]] = sums.get(c[i], 0) + n
        tempered = {v: float(n) ** mixing.TEMPER[dim] for v, n in sums.items()}
        targets.append({v: x / sum(tempered.values()) for v, x in tempered.items()})
    for _ in range(mixing.ROUNDS):
        for i in range(3):
            now = {}
            for c in cells:
                now[c[i]] = now.get(c[i], 0.0) + w[c]
            w = {c: w[c] * targets[i][c[i]] / now[c[i]] for c in cells}
    top = max(w[c] / tokens[c] for c in cells)
    kept = []
    for d in docs:
        p = w[cell(d)] / tokens[cell(d)] / top if cell(d) in w else 1.0
        if int(hashlib.md5(f"7:{d.doc_id}".encode()).hexdigest()[:8], 16) / 2**32 < p:
            kept.append(d.doc_id)
    assert sorted(kept) == sorted(r.doc_id for r in got) and len(kept) < len(docs)


def test_token_ids_are_the_librarys(stages):
    docs, got, _, _ = stages["token_ids"]
    tokenizer, start, want = chunks.load_tokenizer(tokenizer_path()), 0, []
    for d in sorted(docs, key=lambda d: d.doc_id):
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 0]
        want.append((d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want


def test_run_is_its_stages(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF_SMALL).collect())) == sorted(map(str, stages["token_ids"][1]))


def test_no_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF_SMALL, name).limit(0 if name == "documents" else 1000).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert token_ids.token_ids(table(spark, str(tmp_path), "documents"), tokenizer_path()).count() == 0


def test_encoder_of_the_pipeline_keeps_few_parts(spark, monkeypatch):
    """A worker's cache outlives the stage; what it holds is bounded, and the
    ids do not depend on it."""
    asked, real = [], token_ids.write_archive
    monkeypatch.setattr(token_ids, "write_archive", lambda *a, **kw: asked.append(kw.get("cached")) or real(*a, **kw))
    docs = spark.createDataFrame([(i, f"some text {i} with words{i}") for i in range(9)], "doc_id long, text string")
    assert corpus_pipeline.write_token_ids(spark, docs, SF_SMALL).count() == 9
    assert asked == [corpus_pipeline.CACHED_PARTS]
    encoder = chunks.id_encoder(tokenizer_path(), "<u2", 50)
    for i in range(300):
        text = f"one{i} two{i}, {i} three{i}"
        want = chunks.load_tokenizer(tokenizer_path()).encode(text, add_special_tokens=False).ids
        assert encoder(text) == np.array(want, "<u2").tobytes()
        assert len(encoder.first) <= 51 and len(encoder.rest) <= 51
