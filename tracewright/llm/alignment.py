"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often which two meet in the corpus.

Inside a task everything is Arrow: the lists of token ids of a batch are flattened, their documents come from parent indices,
the byte offsets of token ends from cumulative sums less the document's own beginning. A full hash join on (document, end)
of both tokenizers' ends gives, in order, the stretches in which neither tokenizer has an end: each is one link, a pair of tokens
that overlap, and those with an end of both close a group. Table.group_by counts the pairs of a document and of a batch; Spark
merges the batches' counts over the corpus. The links of a document, as distinct pairs with multiplicities, are written once;
the counts come back to them by slices of bounded size.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import dropped, written

#: UTF-8 bytes (about) that are aligned at once; a longer text is cut between words and its parts are put together again.
BLOCK = 2_000_000
#: Pairs with their counts that are broadcast at once; more are broadcast slice after slice.
SLICE = 4_000_000
#: A space after a letter or digit begins a token in either tokenizer, whatever stands around it: the byte-level pattern takes a
#: space as the first character of a token or in a run of white space, and no piece has its space mark after another character.
_BETWEEN = re.compile(r"(?<=[^\W_]) ")
_LETTERS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level() -> dict[str, int]:
    """Characters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers: ids of words, and the bytes of each id."""

    def __init__(self, a_path: str, b_path: str) -> None:
        import sentencepiece

        self.encode_a, a_bytes = _byte_bpe(a_path)
        model = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        # what cutting at _BETWEEN takes for granted of the model
        if any("▁" in p.lstrip("▁") for p in pieces) or [model.id_to_piece(i) for i in model.encode("a  b ")] != ["▁a", "▁", "▁b", "▁"]:
            raise ValueError(f"{b_path}: spaces inside pieces, or spaces that aren't kept")
        self.model, self.space = model, model.piece_to_id("▁")
        b_bytes = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(x, pa.binary()) for x in (a_bytes, b_bytes)]
        self.sizes = [pc.binary_length(x).cast(pa.int64()) for x in self.bytes]
        self.names = [pa.array([str(i) for i in range(len(x))]) for x in self.bytes]

    def encode(self, words: list[str]) -> list[pa.ListArray]:
        """Ids of `space + word` for each word, in both."""
        b = self.model.encode(words, num_threads=1)
        return [self._encode_a(words), pa.array([x or [self.space] for x in b], pa.list_(pa.int32()))]

    def _encode_a(self, words: list[str]) -> pa.ListArray:
        """Words that end in a letter or digit are encoded in one text, whose tokens then end where they do."""
        alone = [k for k, w in enumerate(words) if not w[-1:].isalnum()]
        text, left = [f" {w}" for w in words], set(alone)
        joined = self.encode_a("".join(x for k, x in enumerate(text) if k not in left)) if len(left) < len(text) else []
        sizes = np.array([len(x.encode()) for x in text], np.int64)
        run = np.setdiff1d(np.arange(len(text)), alone)
        n_tokens = np.zeros(len(text), np.int64)
        ends = np.searchsorted(np.cumsum(self.sizes[0].to_numpy()[joined]), np.cumsum(sizes[run])) + 1
        n_tokens[run] = np.diff(ends, prepend=0)
        others = [self.encode_a(text[k]) for k in alone]
        n_tokens[alone] = [len(x) for x in others]
        ids = np.empty(int(n_tokens.sum()), np.int32)
        is_run = np.repeat(~np.isin(np.arange(len(text)), alone), n_tokens)
        ids[is_run], ids[~is_run] = joined, [i for x in others for i in x]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_tokens)]), pa.int32()), pa.array(ids))

    def joined(self, ids: pa.ListArray, which: int) -> pa.Array:
        """The bytes of each list of ids."""
        each = pa.ListArray.from_arrays(ids.offsets, self.bytes[which].take(ids.flatten()))
        return pc.binary_join(each, b"")


def _byte_bpe(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """Encoder and bytes by id of a byte-level vocabulary, special tokens being plain text. Where its merges stand in the order of their ids, tiktoken encodes by the same ranks, faster."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        known = json.load(f)
    shown, special = byte_level(), {x["content"] for x in known["added_tokens"]}
    vocabulary = known["model"]["vocab"]
    entries = {token: bytes(shown[c] for c in token) if token not in special else token.encode() for token in vocabulary}
    by_id = [b""] * (1 + max(*vocabulary.values(), *[x["id"] for x in known["added_tokens"]]))
    for token, i in vocabulary.items():
        by_id[i] = entries[token]
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in known["model"]["merges"]]
    ordered = [vocabulary[m] for m in merges] == list(range(256, 256 + len(merges)))
    first = known["pre_tokenizer"] or {}
    if ordered and not known["normalizer"] and first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space"):
        own = tiktoken.Encoding("own", pat_str=_LETTERS, mergeable_ranks={entries[t]: i for t, i in vocabulary.items() if t not in special}, special_tokens={})
        return own.encode_ordinary, by_id
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    return lambda text: slow.encode(text, add_special_tokens=False).ids, by_id


_pair = cache(Pair)


#: A document-end key has the document (position of its list) above this many bits of the byte offset.
_SHIFT = 40


def _ends(ids: pa.ListArray, sizes: pa.Array) -> pa.Array:
    """The document-end key of every token."""
    parent = pc.list_parent_indices(ids)
    summed = pc.cumulative_sum(sizes.take(ids.flatten()))
    before = pa.concat_arrays([pa.array([0], pa.int64()), summed]).take(ids.offsets.slice(0, len(ids)))
    return pc.add(pc.shift_left(parent.cast(pa.int64()), pa.scalar(_SHIFT, pa.int64())), pc.subtract(summed, before.take(parent)))


def links(a: pa.ListArray, b: pa.ListArray, pair: Pair) -> pa.Table:
    """Links (doc, a, b, a_end, b_end) in order: ids of the two tokens, and which of them end where the stretch does."""
    tables = [pa.table({"end": _ends(ids, sizes), name: ids.flatten()}) for ids, sizes, name in ((a, pair.sizes[0], "a"), (b, pair.sizes[1], "b"))]
    both = tables[0].join(tables[1], "end", join_type="full outer", use_threads=False).sort_by("end")
    doc = pc.shift_right(both.column("end"), pa.scalar(_SHIFT, pa.int64()))
    a_id, b_id = (both.column(n).combine_chunks() for n in ("a", "b"))
    # a token without an end here ends later: the next of its tokenizer; a document ends in both, so nothing reaches over it
    return pa.table({"doc": doc, "a": pc.fill_null_backward(a_id), "b": pc.fill_null_backward(b_id), "a_end": a_id.is_valid(), "b_end": b_id.is_valid()})


def _shown_groups(ids: pa.ListArray, ends: np.ndarray, names: pa.Array) -> pa.Array:
    """`1,2` for each group: ends has for each token whether it closes one."""
    offsets = pa.array(np.concatenate([[0], np.flatnonzero(ends) + 1]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(ids.flatten())), ",")


def _aligned_block(texts: list[str], pair: Pair) -> tuple[pa.Table, list[str], np.ndarray]:
    """Of texts, each to be read with a space before it: (doc, pair, n) counts, shown groups, and (n_a, n_b, n_groups, n_links) of each; -1 where bytes differ."""
    words = [_BETWEEN.split(x) for x in texts]
    each = pa.array([w for x in words for w in x], pa.string()).dictionary_encode()
    of_text = pa.array(np.cumsum([0, *map(len, words)]), pa.int32())
    distinct = each.dictionary.to_pylist()
    encoded = pair.encode(distinct)
    wanted = pa.array([f" {w}".encode() for w in distinct], pa.binary())
    right = pc.and_(*[pc.equal(pair.joined(ids, k), wanted) for k, ids in enumerate(encoded)])
    right_words = right.take(each.indices).to_numpy(zero_copy_only=False)
    wrong = np.concatenate([[0], np.cumsum(~right_words)])[of_text.to_numpy()]
    sound = wrong[1:] == wrong[:-1]
    of_words = [ids.take(each.indices) for ids in encoded]
    lists = [pa.ListArray.from_arrays(x.offsets.take(of_text), x.flatten()) for x in of_words]
    a, b = lists if sound.all() else [x.take(pa.array(np.flatnonzero(sound))) for x in lists]
    t, n = links(a, b, pair), int(sound.sum())
    doc, a_end, b_end = (t.column(c).to_numpy() for c in ("doc", "a_end", "b_end"))
    both = a_end & b_end
    counts = np.full((len(texts), 4), -1, np.int64)
    counts[sound] = np.stack([np.bincount(doc[x], minlength=n) for x in (a_end, b_end, both, np.ones(len(doc), bool))], 1)
    per_group = pc.binary_join_element_wise(_shown_groups(a, both[a_end], pair.names[0]), _shown_groups(b, both[b_end], pair.names[1]), "|")
    groups = np.concatenate([[0], np.cumsum(counts[sound, 2])])
    shown = iter(pc.binary_join(pa.ListArray.from_arrays(pa.array(groups, pa.int32()), per_group), ";").to_pylist())
    key = pc.bit_wise_or(pc.shift_left(t.column("a").cast(pa.int64()), pa.scalar(32, pa.int64())), t.column("b").cast(pa.int64()))
    met = pa.table({"doc": pa.array(np.flatnonzero(sound), pa.int64()).take(t.column("doc")), "pair": key}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    return met.rename_columns(["doc", "pair", "n"]), [next(shown) if x else "" for x in sound], counts


def _parts(texts: list[str | None]) -> Iterator[list[tuple[int, str, bool]]]:
    """Blocks of (position, text, last): texts whole where they fit, long ones cut where _BETWEEN cuts."""
    block, held = [], 0
    for k, text in enumerate(texts):
        at = 0
        while text and at < len(text):
            end = len(text)
            if end - at > BLOCK and (cut := _BETWEEN.search(text, at + BLOCK)):
                end = cut.start()
            if held and held + end - at > BLOCK:
                yield block
                block, held = [], 0
            block.append((k, text[at:end], end == len(text)))
            held += end - at
            at = end + 1  # the space goes before the next part again
            if at == len(text):  # it is the text's last character
                block.append((k, "", True))
    if block:
        yield block


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def _aligned(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    pair = _pair(a_path, b_path)
    for batch in batches:
        # rows of about BLOCK bytes at a time, and a batch of results for them, so that memory doesn't grow with the batch
        of = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // BLOCK
        starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if batch.num_rows else []
        for i, j in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield _aligned_rows(batch.slice(i, j - i), pair)


def _aligned_rows(batch: pa.RecordBatch, pair: Pair) -> pa.RecordBatch:
    texts = batch.column(1).to_pylist()
    counts, digests = np.zeros((len(texts), 4), np.int64), [None] * len(texts)
    wrong, found = np.zeros(len(texts), bool), []
    for block in _parts(texts):
        met, shown, each = _aligned_block([x[1] for x in block], pair)
        owners = np.array([x[0] for x in block])
        found.append(met.set_column(0, "doc", pa.array(owners).take(met.column("doc"))))
        for k, groups, n in zip(owners, shown, each, strict=True):
            wrong[k] |= n[0] < 0
            counts[k] += n
            if digests[k] is None:
                digests[k] = hashlib.sha256()
            else:
                digests[k].update(b";")
            digests[k].update(groups.encode())
    counts[wrong] = 0
    none = pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    met = pa.concat_tables([none, *found])
    met = met.filter(pa.array(~wrong).take(met.column("doc"))).group_by(["doc", "pair"], use_threads=False).aggregate([("n", "sum")]).sort_by([("doc", "ascending"), ("pair", "ascending")])
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(met.column("doc").to_numpy(), minlength=len(texts)))]), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, met.column(c).combine_chunks()) for c in ("pair", "n_sum")]
    hashes = pa.array([d.hexdigest() if d is not None and not w else "" for d, w in zip(digests, wrong, strict=True)], pa.string())
    return pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(counts[:, j]) for j in range(4)], hashes, *lists], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        met = pa.table({"pair": batch.column(0).flatten(), "n": batch.column(1).flatten()}).group_by("pair", use_threads=False).aggregate([("n", "sum")])
        yield from met.select(["pair", "n_sum"]).rename_columns(["pair", "n"]).to_batches()


def _looked_up(sent):
    """(row, n_best, count_sum) of the links whose pair is in the slice that was sent: pairs in order, counts, and whether a count is its B id's highest."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, highest = sent.value
        for batch in batches:
            lists = batch.column(1)
            flat, times = lists.flatten().to_numpy(), batch.column(2).flatten().to_numpy()
            row = pc.list_parent_indices(lists).to_numpy()
            at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row[hit], times[hit] * highest[at[hit]])
            np.add.at(sums[1], row[hit], times[hit] * counts[at[hit]])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1])], ["row", "n_best", "count_sum"])

    return work


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n, best): how many links of the corpus have a pair (A id in the upper, B id in the lower 32 bits), and whether none of its B id has more."""
    partial = aligned.select("pairs", "times").mapInArrow(_partial_counts, "pair long, n long")
    counts = written(partial.groupBy("pair").agg(F.sum("n").alias("n")), "counts")
    b = F.col("pair").bitwiseAND(F.lit(2**32 - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # a row a B id
    return written(counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def alignments(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_pairs: int = SLICE) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of the alignment of tokenizers A (byte-level BPE) and B (sentencepiece).

    A reads a space and the text, B the text, before which it puts a space itself. Null and empty texts, and texts whose tokens
    don't spell them, have no tokens: zeros and an empty string. A very long text is aligned in parts that end between words, where
    both tokenizers end a token. A null id stays null; repeated rows each count; an empty table gives none; other columns are
    ignored.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aligned = written(rows.mapInArrow(lambda x: _aligned(x, a_path, b_path), _ALIGNED).withColumn("row", F.monotonically_increasing_id()), "aligned")
    pairs = pair_counts(aligned)
    slices, of = max(1, -(-pairs.count() // slice_pairs)), F.pmod(F.xxhash64("pair"), F.lit(1_000_003))
    found = []
    for k in range(slices):
        some = pairs.filter(F.pmod(of, F.lit(slices)) == k) if slices > 1 else pairs
        t = some.toArrow().sort_by("pair")  # about slice_pairs rows of 17 bytes
        sent = spark.sparkContext.broadcast(tuple(t.column(c).to_numpy() for c in ("pair", "n", "best")))
        found.append(aligned.select("row", "pairs", "times").mapInArrow(_looked_up(sent), "row long, n_best long, count_sum long"))
    sums = reduce(DataFrame.unionByName, found).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = aligned.drop("pairs", "times").join(sums, "row")
    return out.select(F.col("doc_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
