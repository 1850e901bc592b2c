import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewright.llm import automata, suffixes
from tracewright.llm.windows import bytes_kind, keyed, occurrences, repeated_windows, word_items


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=1, max_size=60) | st.text("ab", min_size=1, max_size=80).map(str.encode))
def test_suffix_array_and_shared_prefixes(raw):
    a = np.frombuffer(raw, np.uint8)
    order = suffixes.suffix_array(a)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
    text = np.r_[np.unique(a, return_inverse=True)[1] + 1, 0]
    for place in (suffixes.induced, suffixes.induced_singly):
        smaller, symbols = suffixes.classified(text), int(text.max()) + 1
        leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
        seeds = np.array(sorted(leftmost.tolist(), key=lambda i: text[i:].tolist()), np.int32)
        assert place(text, smaller, seeds, symbols).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    shared = suffixes.permuted_prefixes(a, order, 9, block=5)
    for r in range(1, len(raw)):
        x, y = raw[order[r] :], raw[order[r - 1] :]
        n = next((k for k in range(9) if x[k : k + 1] != y[k : k + 1] or k >= len(x)), 9)
        assert shared[order[r]] == n


def test_names_are_sorted_by_induction_again(monkeypatch):
    depths, whole = [], suffixes.suffix_order
    monkeypatch.setattr(suffixes, "suffix_order", lambda text, symbols: (depths.append(len(text)), whole(text, symbols))[1])
    raw = np.frombuffer((thue_morse(1024) * 2 + "ab" * 300).encode(), np.uint8)
    assert suffixes.suffix_array(raw).tolist() == sorted(range(len(raw)), key=lambda i: raw[i:].tobytes())
    assert len(depths) > 3 and all(b <= a // 2 + 1 for a, b in zip(depths, depths[1:], strict=False))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3) | st.integers(1, 5000), max_size=90), st.integers(1, 4))
def test_names_are_sorted_by_doubling(names, times):
    text = np.array([*(names * times), 0])
    assert suffixes.doubled(text, int(text.max()) + 1).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_no_long_string_is_induced_singly(monkeypatch):
    sizes, whole = [], suffixes.induced_singly
    monkeypatch.setattr(suffixes, "induced_singly", lambda text, *a: (sizes.append(len(text)), whole(text, *a))[1])
    draw = np.random.default_rng(5)
    part = draw.integers(97, 123, 9000, np.uint8)
    raw = np.concatenate([part, part[::-1], part[:5000], np.full(3000, 97, np.uint8), part[2000:], part])
    order = suffixes.suffix_array(raw)
    assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:].tobytes())
    assert max(sizes, default=0) < suffixes.LONG
    shared = suffixes.permuted_prefixes(raw, order, 400)
    for r in range(1, len(raw), 7):
        x, y = raw[order[r] :][:400], raw[order[r - 1] :][:400]
        size = min(len(x), len(y))
        differ = np.flatnonzero(x[:size] != y[:size])
        assert shared[order[r]] == (differ[0] if len(differ) else size)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=12), max_size=4), st.lists(st.integers(0, 4), max_size=15))
def test_automaton_statistics(texts, asked):
    automaton = automata.Automaton()
    for t in texts:
        automaton.add(t)
    parts = {tuple(t[a:b]) for t in texts for a in range(len(t)) for b in range(a, len(t) + 1)}
    for end, size in enumerate(automaton.statistics(asked), 1):
        assert size == max(k for k in range(end + 1) if k == 0 or tuple(asked[end - k : end]) in parts)


def test_equal_windows_elect_equal_anchors():
    draw = np.random.default_rng(1)
    common = draw.integers(97, 123, 700, np.uint8).tobytes()
    one, two = b"x" * 300 + common + b"y" * 50, b"q" * 77 + common + b"z" * 400
    kind = bytes_kind(400, 100)
    found = []
    for raw, at in ((one, 300), (two, 77)):
        f, g, m, lo, hi = occurrences(raw, kind)
        assert lo[0] == 0 and hi[-1] == len(raw) - 400 and (lo[1:] == hi[:-1] + 1).all()
        found.append({s - at: (fx, mx - at) for fx, mx, a, b in zip(f.tolist(), m.tolist(), lo.tolist(), hi.tolist(), strict=True) for s in range(a, b + 1) if at <= s <= at + 300})
    assert found[0] == found[1] and len(found[0]) == 301


def brute_bytes(rows, n):
    count = Counter()
    raws = [(t or "").encode() for _, t in rows]
    for b in raws:
        count.update(b[k : k + n] for k in range(len(b) - n + 1))
    out = []
    for (i, _), b in zip(rows, raws, strict=True):
        gone = bytearray(len(b))
        for k in range(len(b) - n + 1):
            if count[b[k : k + n]] > 1:
                gone[k : k + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, n):
    """Rows of equal id and text are one document here."""
    seen, told = {}, {}
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = [0] * len(w)
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in seen:
                gone[k : k + n] = [1] * n
            seen.setdefault(tuple(w[k : k + n]), (i, k))
        told[i, t] = (i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode()).hexdigest())
    return sorted((told[r] for r in rows), key=str)


@pytest.fixture(scope="module")
def shared_rows():
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(140) for _ in range(4)]
    rows = []
    for i in range(60):
        text = prose(draw.randint(0, 150))
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(passages)
            a, b = draw.randint(0, 40), draw.randint(90, 140)
            text += "\n" + " ".join(p.split()[a:b]) + " " + prose(draw.randint(0, 40))
        if i % 9 == 0:
            text += ("é" * 500) + "ab " * 300
        rows.append((i, text))
    # copies of a text, and rows that stand there again
    return rows + [(100 + k, rows[5][1]) for k in range(3)] + [rows[9], rows[9], rows[31]] + [(200, "é" * 199), (201, "é" * 200), (202, "é" * 201)]


@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_repeated_bytes_against_brute_force(spark, frame, shared_rows, odd_rows, shard_rows, monkeypatch):
    whole = repeated_windows
    monkeypatch.setattr(suffixes, "repeated_windows", lambda *a, **k: whole(*a, **k, shard_rows=shard_rows))
    rows = shared_rows + odd_rows
    got = [tuple(r) for r in suffixes.without_repeated_bytes(frame(rows)).collect()]
    assert sorted(got, key=str) == brute_bytes(rows, 400)


@pytest.mark.parametrize("shard_rows", [4096, 3])
def test_repeated_words_against_brute_force(spark, frame, shared_rows, odd_rows, shard_rows, monkeypatch):
    whole = repeated_windows
    monkeypatch.setattr(automata, "repeated_windows", lambda *a, **k: whole(*a, **k, shard_rows=shard_rows))
    rows = shared_rows + odd_rows
    got = [tuple(r) for r in automata.without_repeated_spans(frame(rows)).collect()]
    assert sorted(got, key=str) == brute_words(rows, 20)


def test_long_texts_are_worked_on_in_blocks(monkeypatch):
    from tracewright.llm import windows

    draw = np.random.default_rng(3)
    raw = draw.integers(97, 100, 5000, np.uint8).tobytes()
    monkeypatch.setattr(windows, "BLOCK", 700)
    f, g, m, lo, hi = occurrences(raw, bytes_kind(40, 10))
    assert lo[0] == 0 and hi[-1] == 4960 and (lo[1:] == hi[:-1] + 1).all() and (m >= hi).all() and (m <= lo + 30).all()


def test_empty_tables(frame):
    none = frame([(1, "x")]).limit(0)
    assert suffixes.without_repeated_bytes(none).count() == 0
    assert automata.without_repeated_spans(none).count() == 0


def spared_bytes(rows, n):
    """What stays of each (id, text) if each string's first start is spared; rows of equal id and text are one document."""
    import xxhash

    seen, kept = set(), {}
    signed = lambda x: x - (x >> 63 << 64)
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42))))
    for i, t in order:
        b, gone = t.encode(), bytearray(len(t.encode()))
        for k in range(len(b) - n + 1):
            if b[k : k + n] in seen:
                gone[k : k + n] = b"\1" * n
            seen.add(b[k : k + n])
        kept[i, t] = bytes(x for x, g in zip(b, gone, strict=True) if not g).decode("utf-8", "ignore")
    return kept


@pytest.mark.parametrize("shard_rows", [500, 3])
def test_first_copies_are_spared(frame, shared_rows, odd_rows, shard_rows, monkeypatch):
    whole = repeated_windows
    monkeypatch.setattr(suffixes, "repeated_windows", lambda *a, **k: whole(*a, **k, shard_rows=shard_rows))
    rows = shared_rows + odd_rows
    want = spared_bytes(rows, 200)
    out = suffixes.texts_without_repeats(frame(rows), length=200, spare_first=True).select("doc_id", "text").collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter((i, want[i, t or ""]) for i, t in rows)


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_words_of_structured_letters_are_told_apart(frame):
    one = thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    common = " ".join(f"w{k}" for k in range(19))
    rows = [(1, f"{common} {one}"), (2, f"{common} {other}"), (3, f"x {one} {common}")]
    got = {r["doc_id"]: r["n_removed"] for r in automata.without_repeated_spans(frame(rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 0}
    assert len(set(word_items(f"{one} {other}".encode()).tolist())) == 2
    # and so are byte strings of that structure
    rows = [(1, "q" * 150 + one), (2, "q" * 150 + other), (3, one[:700])]
    assert sorted([tuple(r) for r in suffixes.without_repeated_bytes(frame(rows)).collect()], key=str) == brute_bytes(rows, 400)


def test_words_are_split_as_the_whole_text_is(monkeypatch):
    from tracewright.llm import windows

    monkeypatch.setattr(windows, "PART", 10)
    raw = " a bb\tccc\u00a0d \x1c e \x0b\x0c ".encode() * 9 + b"x" * 50
    assert [w for p in windows.word_parts(raw) for w in p] == re.findall(rb"[^\x20\x09-\x0D]+", raw)
    assert list(windows.word_parts(b"")) == [[]]


def test_texts_without_repeats_keeps_rows_and_columns(frame, shared_rows):
    df = frame(shared_rows)
    out = suffixes.texts_without_repeats(df)
    assert out.columns == df.columns and out.count() == df.count()
    want = {i: (n - gone) for i, n, gone, *_ in brute_bytes(shared_rows, 400)}
    for r in out.collect():
        assert want[r["doc_id"]] - 3 <= len(r["text"].encode()) <= want[r["doc_id"]]


def test_reference_spans(spark, frame):
    words = [f"w{k}" for k in range(60)]
    reference = spark.createDataFrame([(" ".join(words[:40]),), (None,)], "text string")
    rows = [(1, "a b " + " ".join(words[5:30]) + " c"), (2, " ".join(words[30:55])), (3, None)]
    got = {r["doc_id"]: r["kept"] for r in automata.remove_reference_spans(frame(rows), reference).collect()}
    assert got == {1: "a b c", 2: " ".join(words[30:55]), 3: ""}
    big = spark.range(1).selectExpr(f"repeat('a b c d ', {automata.REFERENCE_WORDS // 4 + 1}) AS text")
    with pytest.raises(ValueError, match="reference has"):
        automata.remove_reference_spans(frame(rows), big)


def test_keys_of_null_ids(frame):
    assert keyed(frame([(None, None)]), "doc_id", "text").first()["dk"] == -(2**63)
