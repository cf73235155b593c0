"""Aligning the tokens of two tokenizers, batch by batch in Arrow tables.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file), tokenizer B a SentencePiece model.  Both read the
text after one space: A is given it, B adds it.

*Tokens.*  Texts are split at spaces into lists, flattened, and put together again to units no
token reaches across; each distinct unit is encoded once, and its ids are taken for all its occurrences.
*Ends.*  Byte lengths come from a table by id; a cumulative sum, less its value where the document of
the parent index begins, is the byte offset at which a token ends in its document.
*Links.*  An Acero hash join of the two token tables on document and end.  A link is a pair that ends
together; the ends that meet cut both token lists into groups.
*Counts.*  ``Table.group_by`` counts the id pairs of a task; Spark adds these counts up.  The most frequent
pairs, at most ``SHARED_PAIRS``, are sent to all tasks and joined to the links there; links of the
other pairs, each of which is rare, go to their counts by a Spark join.

Units: a space after a letter, digit or ASCII sign begins a token of A in the usual byte-level pattern, and
of B if no piece holds a space after something else.  Where a tokenizer does not have these
properties, whole texts are its units.

Defined cases: texts that are null or empty, or that a tokenizer does not give back byte for byte after
one space, have no tokens: zeros and an empty ``groups``.  Special tokens are ordinary text.  Null
and repeated ids and repeated rows each get a row.  Other columns are left out.
"""

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import small_batches
from termloom.sources.shared import broadcast_within, materialize

# Bytes of text in work at once; one longer text is taken alone.
SLICE_BYTES = 1_000_000
ROW_UNITS = 32
# Units remembered per task, some 50 MB; results do not depend on it.
CACHE_UNITS = 200_000
# Most pairs whose counts are sent to all tasks, some 5 MB.
SHARED_PAIRS = 200_000
# Partial counts of a task are merged when there are this many, and handed on at twice as many.
MERGE_ROWS = 500_000
# Bits of a key that hold the byte offset of an end.
END_BITS = 40

# How a byte-level vocabulary cuts texts before merging, and characters whose classes
# in that pattern are the same in all versions of Unicode in use (letters, digits, signs; no rare spaces).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COMMON = (
    r"\A[\x00-\x7f\x{a1}-\x{2ac}\x{391}-\x{3a1}\x{3a3}-\x{3ce}\x{400}-\x{482}\x{5d0}-\x{5ea}"
    r"\x{621}-\x{63a}\x{641}-\x{64a}\x{905}-\x{939}\x{e01}-\x{e30}\x{2010}-\x{2027}\x{2030}-\x{205e}"
    r"\x{3001}-\x{3003}\x{3041}-\x{3094}\x{30a1}-\x{30fa}\x{4e00}-\x{9fa5}\x{ac00}-\x{d7a3}]*\z"
)
CLOSED = r"[\pL\pN!-~]\z"

Encoder = Callable[[list[str]], list[list[int]]]


def byte_alphabet() -> dict[str, int]:
    """The character by which byte-level vocabularies write each byte: printable Latin-1 characters stand
    for themselves, the other bytes for characters from 256 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """A tokenizer with the bytes of its tokens as Arrow arrays by id.

    ``encode`` gives the ids of each unit, ``encode_all`` those of units of the characters in ``common`` in a row.
    """

    def __init__(self, encode: Encoder, encode_all: Callable[[list[str]], np.ndarray], common: str, tokens: list[bytes | None], by_unit: bool):
        self.encode, self.encode_all, self.common, self.by_unit = encode, encode_all, common, by_unit
        known = [t or b"" for t in tokens]
        self.bytes = pa.array(known, pa.large_binary())
        self.lengths = pa.array([len(t) for t in known], pa.int64())
        self.names = pa.array([str(i) for i in range(len(known))])

    def lists(self, units: pa.Array) -> pa.ListArray:
        """The ids of distinct units.

        Units that leave a cut behind them are encoded as one long text, and its tokens dealt back to
        them by their bytes; all others one by one.
        """
        if not (self.by_unit and len(units)):
            return pa.array(self.encode(units.to_pylist()), pa.list_(pa.int32()))
        plain = pc.and_(pc.match_substring_regex(units, CLOSED), pc.match_substring_regex(units, self.common))
        long, single = units.filter(plain), units.filter(pc.invert(plain))
        ids = pa.array(self.encode_all(long.to_pylist()) if len(long) else [], pa.int32())
        ends = np.cumsum(pc.binary_length(long).to_numpy().astype(np.int64) + 1)
        total = pc.cumulative_sum(self.lengths.take(ids)).to_numpy()
        stops = np.searchsorted(total, ends) + 1
        if len(long) and not (stops[-1] == len(ids) and np.array_equal(total[stops - 1], ends)):
            # Not given back byte for byte, so not to be told apart.
            return pa.array(self.encode(units.to_pylist()), pa.list_(pa.int32()))
        offsets = pa.array(np.insert(stops, 0, 0).astype(np.int32))
        apart = pa.array(self.encode(single.to_pylist()) if len(single) else [], pa.list_(pa.int32()))
        both = pa.concat_arrays([pa.ListArray.from_arrays(offsets, ids), apart])
        plain = plain.to_numpy(zero_copy_only=False)
        return both.take(pa.array(np.where(plain, np.cumsum(plain) - 1, len(long) + np.cumsum(~plain) - 1)))


class Coder:
    """The ids of units by both tokenizers, as lists; units met before are not encoded again."""

    def __init__(self, *vocabularies: Vocabulary):
        self.vocabularies = vocabularies
        self.by_unit = all(v.by_unit for v in vocabularies)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.lists = [pa.array([], pa.list_(pa.int32())) for _ in self.vocabularies]

    def __call__(self, units: pa.Array) -> list[pa.ListArray]:
        if len(self.place) > CACHE_UNITS or not self.by_unit:
            self.forget()
        coded = units.dictionary_encode()
        place, wanted = self.place, coded.dictionary.to_pylist()
        new = [u for u in wanted if u not in place]
        if new:
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            fresh = pa.array(new, pa.string())
            self.lists = [pa.concat_arrays([m, v.lists(fresh)]) for m, v in zip(self.lists, self.vocabularies, strict=True)]
        at = pa.array([place[u] for u in wanted], pa.int32()).take(coded.indices)
        return [lists.take(at) for lists in self.lists]


@lru_cache(maxsize=2)
def byte_bpe(file: bytes) -> Vocabulary:
    """Tokenizer A from the content of its JSON file.

    Where ids follow the order of the merges, ``tiktoken`` gives the same ids from the file's own vocabulary
    in a fifth of the time; it is asked for common characters only.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(file.decode())
    tokenizer.encode_special_tokens = True
    content = json.loads(file)
    alphabet, tokens = byte_alphabet(), {}
    for token, i in tokenizer.get_vocab().items():
        tokens[i] = bytes(map(alphabet.__getitem__, token)) if all(c in alphabet for c in token) else token.encode()

    def encode(units: list[str]) -> list[list[int]]:
        given = [f" {u}" for u in units]
        return [e.ids for e in tokenizer.encode_batch_fast(given, add_special_tokens=False)]

    def encode_all(units: list[str]) -> np.ndarray:
        return _flat(encode(_rows(units)))

    if _merges_in_order(content["model"]):
        from tiktoken import Encoding

        own = set(content["model"]["vocab"].values())
        ranks = {t: i for i, t in tokens.items() if i in own}
        by_rank = Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def encode_all(units: list[str]) -> np.ndarray:
            text = " ".join(["", *units])
            return by_rank.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    pre = content.get("pre_tokenizer") or {}
    usual = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
    plain = usual and not content.get("normalizer")
    return Vocabulary(encode, encode_all, COMMON, [tokens.get(i) for i in range(max(tokens) + 1)], plain)


def _merges_in_order(model: dict) -> bool:
    """Whether an earlier merge always makes a token with a smaller id, and merging has no options."""
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")
    if model.get("type") != "BPE" or any(model.get(o) for o in (*options, "fuse_unk", "ignore_merges")):
        return False
    merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
    ids = [model["vocab"][m] for m in merged]
    return ids == sorted(set(ids))


@lru_cache(maxsize=2)
def sentence_piece(file: bytes) -> Vocabulary:
    """Tokenizer B from the content of its model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_proto=file)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    tokens = [
        bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
        for i, p in enumerate(pieces)
    ]
    by_unit = all("▁" not in p.lstrip("▁") for p in pieces)

    def encode(units: list[str]) -> list[list[int]]:
        return model.encode(units, num_threads=1)

    return Vocabulary(encode, lambda units: _flat(encode(_rows(units))), "", tokens, by_unit)


def _rows(units: list[str]) -> list[str]:
    """Units in rows of some, which costs less than one by one or all at once."""
    return [" ".join(units[i : i + ROW_UNITS]) for i in range(0, len(units), ROW_UNITS)]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int32)


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Units of the texts and the text each is of.  The space before a unit is left out."""
    words = pc.split_pattern(texts, " ")
    flat, parent = pc.list_flatten(words), pc.list_parent_indices(words).to_numpy()
    coded = flat.dictionary_encode()
    closed = pc.match_substring_regex(coded.dictionary, CLOSED).take(coded.indices)
    # A word after a space that may not be cut belongs to the unit before it, and so does an empty one.
    closed = closed.to_numpy(zero_copy_only=False)
    begins = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False).copy()
    begins[1:] &= closed[:-1]
    begins[1:] |= parent[1:] != parent[:-1]
    begins[:1] = True
    if begins.all():
        return flat, parent
    starts = np.flatnonzero(begins)
    offsets = pa.array(np.append(starts, len(flat)).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, flat), " "), parent[starts]


class Tokens:
    """The tokens of a batch of texts: ids, document, and the byte offset where each ends."""

    def __init__(self, vocabulary: Vocabulary, texts: pa.Array, lists: pa.ListArray, parent: np.ndarray):
        self.names = vocabulary.names
        self.ids = pc.list_flatten(lists)
        self.doc = parent[pc.list_parent_indices(lists).to_numpy()]
        total = pc.cumulative_sum(vocabulary.lengths.take(self.ids)).to_numpy()
        first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.bytes_before = np.insert(total, 0, 0)[first]
        self.ends = total - self.bytes_before[self.doc]
        joined = vocabulary.bytes.take(self.ids)
        self.texts = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(self.bytes_before.astype(np.int64)), joined.buffers()[2]]
        )

    def keep(self, good: np.ndarray) -> pa.Table:
        """The tokens of the good documents as a table."""
        chosen = good[self.doc]
        self.ids, self.doc, self.ends = self.ids.filter(pa.array(chosen)), self.doc[chosen], self.ends[chosen]
        key = (self.doc.astype(np.int64) << END_BITS) + self.ends
        return pa.table({"key": key, "at": np.arange(len(key))})

    def groups(self, cut: np.ndarray) -> pa.Array:
        """The ids of each group, joined by commas; a group ends with a token that is cut."""
        offsets = pa.array(np.insert(cut + 1, 0, 0).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.names.take(self.ids)), ",")


def _firsts(rising: np.ndarray) -> np.ndarray:
    """Where a value of a sorted array occurs first."""
    return np.flatnonzero(np.diff(rising, prepend=-1))


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.ListArray:
    """One list per owner of values that are in the order of their owners."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def align_texts(texts: pa.Array, coder: Coder) -> dict[str, pa.Array]:
    """The aligned columns of texts, none of them null."""
    n = len(texts)
    units, parent = units_of(texts) if coder.by_unit else (texts, np.arange(n))
    both = zip(coder.vocabularies, coder(units), strict=True)
    tokens = [Tokens(v, texts, lists, parent) for v, lists in both]
    expected = pc.binary_join_element_wise(pa.scalar(""), texts, " ").cast(pa.large_binary())
    good = pc.greater(pc.binary_length(texts), 0)
    for t in tokens:
        good = pc.and_(good, pc.equal(t.texts, expected))
    good = good.to_numpy(zero_copy_only=False)
    ta, tb = (t.keep(good) for t in tokens)
    links = ta.join(tb.rename_columns(["key", "bt"]), "key", join_type="inner", use_threads=False)
    links = links.combine_chunks()
    if (np.diff(links["key"].to_numpy()) < 0).any():
        links = links.sort_by("key")
    at_a, at_b = (links[c].to_numpy() for c in ("at", "bt"))
    doc = links["key"].to_numpy() >> END_BITS
    cut = _firsts(links["key"].to_numpy())
    sides = [t.groups(at[_firsts(at)]) for t, at in zip(tokens, (at_a, at_b), strict=True)]
    groups = pc.binary_join_element_wise(*sides, "|")
    return {
        "n_a": pa.array(np.bincount(tokens[0].doc, minlength=n)),
        "n_b": pa.array(np.bincount(tokens[1].doc, minlength=n)),
        "n_groups": pa.array(np.bincount(doc[cut], minlength=n)),
        "n_links": pa.array(np.bincount(doc, minlength=n)),
        "groups": pc.binary_join(_lists(groups, doc[cut], n), ";"),
        "link_a": _lists(tokens[0].ids.take(pa.array(at_a)), doc, n),
        "link_b": _lists(tokens[1].ids.take(pa.array(at_b)), doc, n),
    }


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of at most ``SLICE_BYTES`` together, or of one text."""
    sizes = pc.binary_length(texts).to_numpy()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes):
        yield start, len(sizes)


def align(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, groups, link_a, link_b)`` of every row.

    ``groups`` writes a document as ``a1,a2|b1;a3|b2,b3``: ids of A and of B between two common ends.
    ``link_a`` and ``link_b`` are the ids of its links, in order.
    """
    # The files are some megabytes; their contents are sent, as paths may differ on other machines.
    files = docs.sparkSession.sparkContext.broadcast((Path(path_a).read_bytes(), Path(path_b).read_bytes()))
    given = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = T.StructType(
        [
            given.schema["doc_id"],
            *(T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")),
            T.StructField("groups", T.StringType()),
            *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("link_a", "link_b")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        coder = Coder(byte_bpe(files.value[0]), sentence_piece(files.value[1]))
        for batch in batches:
            texts = batch["text"].cast(pa.string())
            for start, stop in _slices(texts):
                made = {"doc_id": batch["doc_id"][start:stop]} | align_texts(texts[start:stop], coder)
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return given.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(a, b, count)`` of each id pair: how many links of all documents hold it."""

    def grouped(table: pa.Table, what: tuple) -> pa.Table:
        made = table.group_by(["a", "b"], use_threads=False).aggregate([what])
        return made.select(["a", "b", made.column_names[-1]]).rename_columns(["a", "b", "count"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        held, rows = [], 0
        for batch in batches:
            links = pa.table({c: pc.list_flatten(batch[f"link_{c}"]) for c in "ab"})
            held.append(grouped(links, ([], "count_all")))
            rows += len(held[-1])
            if rows > MERGE_ROWS:
                held = [grouped(pa.concat_tables(held), ("count", "sum"))]
                rows = len(held[0])
                if rows > 2 * MERGE_ROWS:
                    yield from held.pop().to_batches()
                    rows = 0
        if held:
            yield from grouped(pa.concat_tables(held), ("count", "sum")).to_batches()

    partial = aligned.select("link_a", "link_b").mapInArrow(run, "a int, b int, count long")
    return partial.groupBy("a", "b").agg(F.sum("count").alias("count"))


def _share_bin():
    """Pairs are ordered by quarters of powers of two of their counts."""
    return F.floor(F.log2("count") * 4).cast("int")


def with_counts(aligned: DataFrame) -> DataFrame:
    """``aligned`` without the links, with ``n_best`` and ``count_sum``.

    ``count_sum`` adds up the counts of a document's links, ``n_best`` is the number of those whose count is
    the highest among the pairs of their id of B.
    """
    spark = aligned.sparkSession
    kept = [c for c in aligned.columns if c not in ("link_a", "link_b")]
    with small_batches(spark, 500):
        rows = materialize(aligned.withColumn("row", F.monotonically_increasing_id()), "align-rows")
        counts = materialize(pair_counts(rows), "align-counts")
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    # One row per id of B that is in a link.
    highest = broadcast_within(highest, counts.agg(F.approx_count_distinct("b", 0.01)).first()[0])
    best = (F.col("count") == F.col("highest")).cast("int").alias("best")
    counts = materialize(counts.join(highest, "b").select("a", "b", "count", best, _share_bin().alias("bin")), "align-best")
    sizes = sorted(counts.groupBy("bin").count().collect(), reverse=True)
    from_bin, pairs = 1 << 30, 0
    for size in sizes:
        pairs += size["count"]
        if pairs > SHARED_PAIRS:
            break
        from_bin = size["bin"]
    frequent = counts.filter(F.col("bin") >= from_bin).select("a", "b", "count", "best").toArrow()
    with small_batches(spark, 500):
        summed = materialize(_summed(rows.select(*kept, "row", "link_a", "link_b"), frequent, kept), "align-summed")
    rare = counts.filter(F.col("bin") < from_bin)
    rest = summed.select("row", F.inline("rest")).join(rare, ["a", "b"])
    rest = rest.groupBy("row").agg(
        F.sum(F.col("n") * F.col("count")).alias("more_sum"), F.sum(F.col("n") * F.col("best")).alias("more_best")
    )
    both = summed.join(rest, "row", "left")
    return both.select(
        *kept,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


def _summed(rows: DataFrame, frequent: pa.Table, kept: list[str]) -> DataFrame:
    """Sums over the links of frequent pairs, and ``rest``: the other pairs of a row."""
    key = pc.bit_wise_or(pc.shift_left(frequent["a"].cast(pa.int64()), 32), frequent["b"].cast(pa.int64()))
    known = pa.table({"pair": key, "count": frequent["count"], "best": frequent["best"].cast(pa.int64())})
    known = spark_broadcast(rows, known)
    schema = T.StructType(
        [
            *(rows.schema[c] for c in (*kept, "row")),
            T.StructField("n_best", T.LongType()),
            T.StructField("count_sum", T.LongType()),
            T.StructField("rest", T.ArrayType(T.StructType(
                [T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("n", T.LongType())]
            ))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        shared = pa.ipc.open_stream(known.value).read_all()
        for batch in batches:
            n = len(batch)
            a, b = (pc.list_flatten(batch[f"link_{c}"]).cast(pa.int64()) for c in "ab")
            links = pa.table({
                "doc": pc.list_parent_indices(batch["link_a"]).cast(pa.int64()),
                "pair": pc.bit_wise_or(pc.shift_left(a, 32), b),
            })
            pairs = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
            met = pairs.join(shared, "pair", join_type="left outer", use_threads=False).combine_chunks()
            doc, times = met["doc"].to_numpy(), met["count_all"].to_numpy()
            count, best = (pc.fill_null(met[c], 0).to_numpy() for c in ("count", "best"))
            sums = {name: np.zeros(n, dtype=np.int64) for name in ("n_best", "count_sum")}
            np.add.at(sums["n_best"], doc, times * best)
            np.add.at(sums["count_sum"], doc, times * count)
            rest = met.filter(pc.is_null(met["count"])).sort_by("doc")
            pair = rest["pair"].to_numpy()
            cells = pa.StructArray.from_arrays(
                [
                    pa.array((pair >> 32).astype(np.int32)),
                    pa.array((pair & 0xFFFFFFFF).astype(np.int32)),
                    pa.array(rest["count_all"].to_numpy()),
                ],
                names=["a", "b", "n"],
            )
            made = {c: batch[c] for c in (*kept, "row")} | {c: pa.array(v) for c, v in sums.items()}
            made["rest"] = _lists(cells, rest["doc"].to_numpy(), n)
            yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return rows.mapInArrow(run, schema)


def spark_broadcast(df: DataFrame, table: pa.Table):
    """A broadcast of the table in Arrow's stream format."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    return df.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
