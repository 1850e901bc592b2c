import hashlib
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tracewright.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain_tokens():
    """text -> ((id, bytes) of A, of B) by the libraries alone, or None."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    shown = alignment.byte_level()

    def tokens(text):
        if not text:
            return None
        x = [(i, bytes(shown[c] for c in a.id_to_token(i))) for i in a.encode(f" {text}", add_special_tokens=False).ids]
        y = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        whole = f" {text}".encode()
        return (x, y) if b"".join(t for _, t in x) == whole == b"".join(t for _, t in y) else None

    return tokens


def plain(rows, tokens):
    met, found = Counter(), []
    for i, text in rows:
        pair = tokens(text)
        if pair is None:
            found.append((i, None))
            continue
        spans = []
        for ids in pair:
            at, own = 0, []
            for k, t in ids:
                own.append((at, at + len(t), k))
                at += len(t)
            spans.append(own)
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        ends = sorted({x[1] for x in spans[0]} & {y[1] for y in spans[1]})
        groups = ";".join("|".join(",".join(str(x[2]) for x in own if a <= x[0] and x[1] <= z) for own in spans) for a, z in zip([0, *ends], ends, strict=False))
        met.update(links)
        found.append((i, (len(pair[0]), len(pair[1]), len(ends), links, hashlib.sha256(groups.encode()).hexdigest())))
    most = Counter()
    for (_, b), n in met.items():
        most[b] = max(most[b], n)
    out = []
    for i, x in found:
        if x is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((i, *x[:3], len(x[3]), sum(met[p] == most[p[1]] for p in x[3]), sum(met[p] for p in x[3]), x[4]))
    return out


ODD = ["<|endoftext|> <s> a</s>", "<0x0A>", "a▁b", "▁", " ", "  ", "a  b   c ", "tab\tand\nline \n x", "don't we'll 12 345", "é à ñ 漢字 \U0001f600", "a\x00b", "é ́x", "  b　 c", "word" * 300, "x. y, z! (a) b", "٣ ٤", "ﬁ ½ Å"]


def key(r):
    return tuple((x is None, x) for x in r)


def test_alignments_against_plain_ones(spark, frame, odd_rows, plain_tokens):
    rows = odd_rows + [(100 + k, t) for k, t in enumerate(ODD)]
    rows = [(i, t and t[:3000]) for i, t, *_ in rows]
    got = alignment.alignments(frame(rows), A, B)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, plain_tokens), key=key)


@pytest.mark.parametrize("size", [7, 1000])
def test_pairs_come_back_slice_after_slice(spark, frame, plain_tokens, size):
    rows = [(k, t) for k, t in enumerate(ODD)]
    got = alignment.alignments(frame(rows), A, B, slice_pairs=size)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows, plain_tokens))


def test_long_texts_are_aligned_in_parts(plain_tokens, monkeypatch):
    import pyarrow as pa

    texts = [" ".join(ODD), None, "ab " * 50, "", "one two ", "three  four  ", "nospace" * 20, "a▁b " * 30]

    def all_of(block):
        monkeypatch.setattr(alignment, "BLOCK", block)
        out = alignment._aligned(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["a", "b"])]), A, B)
        return pa.Table.from_batches(out).to_pylist()

    whole = all_of(10**6)
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in whole] == [x[1:5] + x[7:] for x in plain(list(enumerate(texts)), plain_tokens)]
    for block in (1, 3, 10, 200):
        assert all_of(block) == whole


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1 é.'\n\t▁ 漢<s>|_"), max_size=25), min_size=1, max_size=4))
def test_words_are_encoded_as_in_their_text(plain_tokens, texts):
    pair = alignment._pair(A, B)
    for text in filter(None, texts):
        tokens, words = plain_tokens(text), alignment._BETWEEN.split(text)
        a, b = (x.flatten().to_pylist() for x in pair.encode(words))
        if tokens:
            assert a == [i for i, _ in tokens[0]] and b == [i for i, _ in tokens[1]]


def test_empty_table(spark, frame):
    out = alignment.alignments(frame([(1, "a")]).limit(0), A, B)
    assert out.collect() == [] and out.columns == COLUMNS
