"""Packing, sharding and mixing: their laws, checked row by row."""

import zlib

import numpy as np
import pytest

from fleetwarden.llm.mixing import mix_sources, source_targets, take_mix
from fleetwarden.llm.packing import Words, pack_documents, plan, tokenizer_path
from fleetwarden.llm.sharding import differenced, labels, shard_by_bytes

ODD_TEXTS = ["a.,b, c. D.", "İİ Σας ΟΔΟΣ. x", "é ́x ,́", "foo's, it's. 's ..., a!, 12.,3. 4,", "\t tab　wide nbsp. x", "<|endoftext|> a<|startoftext|>b.",
             "", "  ", "x\n\n,y.\n", "naïve, Ñandú. ßß. É", "½. ²,a 中.文, x_. _,", "a\x1cb \x85.\x85 c.", "Ω.Å K, ﬁ ﬀ İ"]


def test_remembered_chunks_equal_whole_texts(docs):
    words = Words(tokenizer_path())
    texts = ODD_TEXTS + [r.text for r in docs.select("text").limit(150).collect()]
    for _ in range(2):
        got = [np.frombuffer(x, dtype="<u4").tolist() for x in words.ids(texts)]
        assert got == [e.ids for e in words.tok.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_gapless_and_tight(seed):
    rng = np.random.default_rng(seed)
    capacity = 100
    sizes = rng.integers(1, [101, 35, 100, 61, 6, 81][seed], 3000)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(sizes, return_counts=True))}
    bins: dict = {}
    ranks = {k: set() for k in histogram}
    for length, first, n, sequence, at in plan(histogram, capacity):
        for k in range(n):
            assert first + k not in ranks[length]
            ranks[length].add(first + k)
            bins.setdefault(sequence + k, []).append((at, length))
    assert all(ranks[k] == set(range(n)) for k, n in histogram.items())
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= capacity
        assert sum(3 * length > capacity for _, length in content) <= 2
    assert len(bins) <= 1.03 * max(sizes.sum() / capacity, (sizes > 50).sum()) + 2


def packed_right(df, out, capacity):
    words = Words(tokenizer_path())
    got: dict = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r)
    for r in df.select("doc_id", "text").distinct().collect():
        ids = np.append(np.frombuffer(words.ids([r.text or ""])[0], dtype="<u4"), 0).astype("<u4")
        want = [(k, at, min(capacity, len(ids) - at), zlib.crc32(ids[at: at + capacity].tobytes())) for k, at in enumerate(range(0, len(ids), capacity))]
        assert set(want) <= {(x.piece, x.start, x.length, x.ids_crc32) for x in got[r.doc_id]}
    sequences: dict = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for content in sequences.values():
        assert [o for o, _ in sorted(content)] == [0, *np.cumsum([n for _, n in sorted(content)])[:-1]]
        assert sum(n for _, n in content) <= capacity
    return len(sequences)


def test_pack_documents(docs, odd, none):
    out = pack_documents(docs).collect()
    assert packed_right(docs, out, 2048) <= sum(r.length for r in out) / 2048 * 1.02 + 1
    out = pack_documents(odd, capacity=64).collect()
    packed_right(odd, out, 64)
    assert sum(r.doc_id == 3 and r.piece == 0 for r in out) == 2
    assert pack_documents(none).count() == 0


def test_differencing():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 1000, 200).tolist()
    last, parent = differenced([[(s, k), (0, -1), (0, -1)] for k, s in enumerate(sizes)])
    part = labels(last, parent)[:200]
    sums = [sum(s for s, p in zip(sizes, part) if p == k) for k in range(3)]
    assert sorted(sums) == sorted(s for s, _ in last) and max(sums) - min(sums) <= 2


@pytest.mark.parametrize("run_groups", [2000, 7])
def test_shards(docs, odd, none, run_groups):
    rows = shard_by_bytes(docs, 5, run_groups=run_groups, fan_in=4).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    shard_of: dict = {}
    sums = [0] * 5
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 16 and r.text_crc32 == zlib.crc32(raw) and r.law == "bytes" and r.grown_shard is None
        assert shard_of.setdefault(raw, r.shard) == r.shard
        sums[r.shard] += r.size
    for s in range(5):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    assert max(sums) - min(sums) < 0.02 * sum(sums)
    got = shard_by_bytes(odd, 3, run_groups=run_groups).collect()
    assert len(got) == odd.count() and len({r.shard for r in got if r.doc_id in (0, 1)}) == 1
    assert shard_by_bytes(none).count() == 0


def leveled(sizes, weights, share=1.5, cap=2.0):
    """Targets by cutting and sharing again until none is above its cap."""
    total, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        rest = total - sum(t for k, t in enumerate(target) if k not in open_)
        for k in open_:
            target[k] = rest * weights[k] / sum(weights[j] for j in open_)
        above = {k for k in open_ if target[k] > cap * sizes[k]}
        for k in above:
            target[k] = cap * sizes[k]
        open_ -= above
        if not above:
            break
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, [100, 10_000, 5, 3000][seed], 11).tolist()
    names = [f"s{k:02d}" for k in range(10)] + [None]
    df = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    assert [got[n] for n in names] == pytest.approx(leveled(sizes, [(3, 1, 2)[k % 3] for k in range(11)]))


def test_mix(docs, odd, none):
    for group_rows in (2000, 3):
        rows = mix_sources(docs, group_rows=group_rows, fan_in=2).collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
        by: dict = {}
        for r in rows:
            assert r.taken == r.copies * r.size and 0 <= r.taken <= 2 * r.size
            assert r.copies in (int(r.target / r.source_size), int(r.target / r.source_size) + 1)
            by.setdefault(r.source, []).append(r)
        for part in by.values():
            assert abs(sum(r.taken for r in part) - part[0].target) <= max(r.size for r in part) / 2 + 1e-6
        again = mix_sources(docs.repartition(7), group_rows=group_rows, fan_in=2).collect()
        assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    rows = mix_sources(odd).collect()
    assert len(rows) == odd.count() and all(r.taken == 0 for r in rows if r.doc_id in (0, 1, 2))
    taken = take_mix(odd)
    assert taken.columns == odd.columns and taken.count() == sum(r.copies for r in rows)
    assert mix_sources(none).count() == 0 and take_mix(none).count() == 0


def test_special_tokens_in_texts_have_the_ids_of_the_tokenizer(spark):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["end <|endoftext|> next", "a<|startoftext|>b.", "a<|ENDOFTEXT|>b <|endoftext|> A <|EndOfText|>", "<|end<|endoftext|>oftext|>", "İ<|endoftext|>İ X",
             "x\n<|endoftext|>\nY <|endoftext|><|startoftext|>Z", "<|endoftext|>", "<| endoftext |> <|endoftext", *ODD_TEXTS]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [806, 49407, 1131]
    words = Words(tokenizer_path())
    for _ in range(2):
        assert [np.frombuffer(x, dtype="<u4").tolist() for x in words.ids(texts)] == want
        assert [np.frombuffer(words.ids([t])[0], dtype="<u4").tolist() for t in texts] == want
    got = {r.doc_id: r for r in pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [(got[k].length, got[k].ids_crc32) for k in range(len(texts))] == [
        (len(w) + 1, zlib.crc32(np.array([*w, 0], dtype="<u4").tobytes())) for w in want]


def test_punctuation_at_the_end_of_chunks_is_encoded_apart(monkeypatch):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["word word. word,$$$ Word! 12. é. é. x’. dogs'. x's., 's 's. ab' ≠ .a. A.B.C. ª. ²³. … a… a_b_ -- ÿ! İ. ſ.",
             "x<|endoftext|>. <|endoftext|>., <|ENDOFTEXT|>.", "中。 中. K. a1, 1a. ́. á."]
    words, lines = Words(tokenizer_path()), []
    whole = Words.encode_lines
    monkeypatch.setattr(Words, "encode_lines", lambda self, chunks: lines.extend(chunks) or whole(self, chunks))
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in words.ids(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert "word" not in lines and "word." not in lines and lines.count(".") == 1


def test_known_stems_and_latin_words_need_no_tokenizer(monkeypatch):
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer_path())
    words, lines, modelled = Words(tokenizer_path()), [], []
    whole, one = Words.encode_lines, Words.word
    monkeypatch.setattr(Words, "encode_lines", lambda self, chunks: lines.extend(chunks) or whole(self, chunks))
    monkeypatch.setattr(Words, "word", lambda self, text: modelled.append(text) or one(self, text))
    texts = ["Zwölfgründe übernaïveté ßÿµªº", "zwölfgründe, übernaïveté!! zwölfgründe,", "zwölfgründe, ﬁn ça", "x" * 50 + " é́ Ωé " + "x" * 50 + "."]
    for _ in range(2):
        for text in texts:
            got = np.frombuffer(words.ids([text])[0], dtype="<u4").tolist()
            assert got == plain.encode(text, add_special_tokens=False).ids
    assert not {"zwölfgründe", "übernaïveté", "ça"} & set(lines) and "ﬁn" in lines
    assert modelled.count("zwölfgründe") == modelled.count("übernaïveté") == modelled.count("ça") == 1
