import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tessera.llm import chunks, packing, token_counts

PATH = chunks.default_path()


def plain(text):
    return chunks.tokenizer(PATH).encode(text or "", add_special_tokens=False).ids


def test_chunks_give_the_ids_of_the_whole_text():
    r = random.Random(1)
    bits = list("ab1.'s é  \n\n\t  \x1c,!|<#ñǅ") + ["<|endoftext|>", "'re", "中", "٣", "😀", "́", "word", ". ",
                                                               chunks.MARK]
    texts = ["".join(r.choice(bits) for _ in range(r.randint(0, 16))) for _ in range(20_000)]
    for t, ids in zip(texts, chunks.ids_of(PATH, texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain(t), t
        assert "".join(chunks.cut(t)) == t or chunks.MARK in t and "".join(chunks.cut(t)) == t


def test_token_counts_edges(odd_docs, no_docs, monkeypatch):
    rows = odd_docs.select("doc_id", "text").collect()
    want = Counter((r[0], len((r[1] or "").encode()), len(plain(r[1])), len(plain(r[1])) > 1024) for r in rows)
    assert Counter(map(tuple, token_counts.token_counts(odd_docs).collect())) == want
    # With a small head nearly all pre-tokens go through the join.
    monkeypatch.setattr(token_counts, "HEAD", 5)
    assert Counter(map(tuple, token_counts.token_counts(odd_docs).collect())) == want
    assert token_counts.token_counts(no_docs).count() == 0


def best_fit_plain(sizes, capacity):
    bins = []
    for s in sorted(sizes, reverse=True):
        fits = [b for b in bins if b >= s]
        if fits:
            bins.remove(min(fits))
            bins.append(min(fits) - s)
        else:
            bins.append(capacity - s)
    return sorted(bins)


def test_best_fit_is_best_fit_decreasing():
    r = random.Random(2)
    for _ in range(1500):
        capacity = r.choice([1, 5, 8, 20, 31, 64])
        sizes = [r.randint(1, capacity) for _ in range(r.randint(0, 40))]
        falling, fill, seen = sorted(sizes, reverse=True), {}, []
        for pos, n, seq, step, offset in packing.best_fit(Counter(sizes), capacity):
            for k in range(n):
                seen.append(pos + k)
                fill.setdefault(seq + k * step, []).append((offset, falling[pos + k]))
        assert seen == list(range(len(sizes)))
        for places in fill.values():
            at = 0
            for offset, size in sorted(places):
                assert offset == at
                at += size
        assert sorted(capacity - sum(s for _, s in p) for p in fill.values()) == best_fit_plain(sizes, capacity)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_pack_edges(odd_docs, no_docs, capacity):
    rows = odd_docs.select("doc_id", "text").collect()
    out = packing.pack(odd_docs, capacity=capacity, with_ids=True)
    got = out.collect()
    want = Counter()
    for doc, text in rows:
        ids = plain(text) + [0]
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            want[doc, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == len(best_fit_plain([r.length for r in got], capacity))
    full = {r.sequence_id: r for r in packing.sequences(out).collect()}
    assert all(len(full[s].ids) == 4 * sum(n for _, n in p) for s, p in bins.items())
    assert packing.pack(no_docs).count() == 0


def test_kept_ids_are_bounded_by_bytes():
    """Text without spaces is one chunk a line: right ids, nothing kept."""
    import random

    from tessera.llm import chunks

    r = random.Random(1)
    path = chunks.default_path()
    plain = chunks.tokenizer(path)
    lines = ["".join(chr(r.randint(0x4E00, 0x9FFF)) for _ in range(500)) for _ in range(40)]
    lines += ["".join(r.choice("ABCDEFghijkl0123+/") for _ in range(2000)) for _ in range(40)]
    ids = chunks.Ids(path)
    for text in ["\n".join(lines), "some words. <|endoftext|> and  two spaces", ""]:
        want = plain.encode(text, add_special_tokens=False).ids
        assert ids.of(text) == b"".join(i.to_bytes(4, "little") for i in want)
    assert ids.held < 64 * 1000 and all(len(c) <= chunks.KEPT_CHARS for c in ids)
    ids.held = chunks.KEPT_BYTES + 1
    ids.of("a b")
    assert len(ids) <= 3
