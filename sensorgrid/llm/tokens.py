"""Token ids in binary shards: Simple-8b words, escapes and per-block offsets.

:func:`encode_ids` packs ids greedily into 64-bit words: a 4-bit selector says how many ids of
how many bits share the other 60 (from 240 zeros to one id of 60 bits). An id of more than 30
bits is written as an escape: a zero in the words, and its place and value in a list at the
end. Every :data:`BLOCK_WORDS` words a header entry gives the number of ids before, so a
reader decodes blocks alone, each selector's words at once in numpy.

:func:`write_shards` range-partitions documents by doc_id, tokenizes each whole text, ends it
with an end id and writes records of whole documents in ascending doc_id order;
:func:`read_shards` reads the files back. The container is Parquet, one record per row, so
commits, retries and remote stores are Spark's: a lost executor's task writes its file again.

Scale: one shuffle of the texts; a shard is one task's range, of which a task holds one record
(about :data:`RECORD_IDS` ids) at a time. Offsets across shards come from one count per shard.

Defined cases: null or empty text has only the end id; null doc_ids come first; equal doc_ids
are ordered by text digest, then as hashed whole rows; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex as re
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import pack_hash, scratch_path, small_batches, text_of
from sensorgrid.session import ensure_checkpoint_dir

#: (ids per word, bits per id) by selector.
SELECTORS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)
MAGIC = b"S8B1"
BLOCK_WORDS = 4096
ESCAPE_BITS = 30
RECORD_IDS = 1 << 18
#: Bytes of text that are encoded together.
PORTION = 1 << 23
END_ID = 1
#: Words, and pieces, whose ids a worker remembers, in each of two generations (some 200 bytes each).
MEMO = 300_000
#: Word pieces as the pre-tokenizer cuts them, and the space that joins words here.
PIECES = re.compile(r" |'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Texts of these characters only are lower-cased and cut as wholes: ASCII but controls, and Latin-1
#: letters, which have no other composed form. In them a piece that is no word is one of the latter.
SIMPLE = r"^[\x09-\x0D\x20-\x7E\x{C0}-\x{FF}]*$"
CUTS = r"('(?:s|t|re|ve|m|ll|d)|[0-9]|[^a-z0-9\x{DF}-\x{F6}\x{F8}-\x{FF}\x09-\x0D\x20]+)"
#: What the above rests on, in the tokenizer's file.
EXPECTED = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None, "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
    "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}
#: Controls, odd white space and scripts whose letters two libraries may know differently.
ODD = r"[\x00-\x1F\x7F-\xA0\u0530-\U0010FFFF]"


def encode_ids(ids: np.ndarray) -> bytes:
    """Header (magic, ids, words, escapes, blocks), ids before each block, words, escapes."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    big = np.flatnonzero(ids >> np.uint64(ESCAPE_BITS))
    escaped = ids[big]
    low = ids.copy()
    low[big] = 0
    # widest of the next c ids, from that of fewer: the largest c whose bits hold them decides
    choice = np.full(n, len(SELECTORS) - 1, np.uint8)
    widest = {1: np.searchsorted(_POWERS, low, side="right").astype(np.uint8)}
    for s in range(len(SELECTORS) - 2, -1, -1):
        count, bits = SELECTORS[s]
        if count > n:
            break
        part = min(c for c in widest if 2 * c >= count)
        w = widest[count] = np.maximum(widest[part][:n - count + 1], widest[part][count - part:])
        choice[:n - count + 1][w <= bits] = s
    counts = np.array([c for c, _ in SELECTORS])
    step = counts[choice].tolist()
    at, i = [], 0
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at, np.int64)
    sel = choice[at] if n else np.zeros(0, np.uint8)
    words = sel.astype(np.uint64) << np.uint64(60)
    for s in np.unique(sel):
        count, bits = SELECTORS[s]
        if bits:
            own = np.flatnonzero(sel == s)
            vals = low[at[own][:, None] + np.arange(count)] << (np.arange(count, dtype=np.uint64) * np.uint64(bits))
            words[own] |= np.bitwise_or.reduce(vals, axis=1)
    before = at[::BLOCK_WORDS]
    head = np.array([n, len(words), len(big), len(before)], "<u8")
    return b"".join([MAGIC, head.tobytes(), before.astype("<u8").tobytes(), words.astype("<u8").tobytes(),
                     big.astype("<u8").tobytes(), escaped.astype("<u8").tobytes()])


def decode_ids(blob: bytes, blocks: slice | None = None) -> np.ndarray:
    """All ids, or those of some blocks (a slice of block numbers)."""
    if blob[:4] != MAGIC:
        raise ValueError("not a Simple-8b record")
    n, n_words, n_big, n_blocks = (int(x) for x in np.frombuffer(blob, "<u8", 4, 4))
    before = np.frombuffer(blob, "<u8", n_blocks, 36).astype(np.int64)
    words = np.frombuffer(blob, "<u8", n_words, 36 + 8 * n_blocks)
    tail = 36 + 8 * (n_blocks + n_words)
    big, escaped = np.frombuffer(blob, "<u8", n_big, tail).astype(np.int64), np.frombuffer(blob, "<u8", n_big, tail + 8 * n_big)
    lo, hi, _ = (blocks or slice(None)).indices(n_blocks)
    first = int(before[lo]) if lo < n_blocks else n
    last = int(before[hi]) if hi < n_blocks else n
    words = words[lo * BLOCK_WORDS:hi * BLOCK_WORDS]
    sel = (words >> np.uint64(60)).astype(np.int64)
    count = np.array([c for c, _ in SELECTORS])[sel]
    at = np.cumsum(count) - count
    out = np.zeros(max(0, last - first), np.uint64)
    for s in np.unique(sel):
        c, bits = SELECTORS[s]
        if bits:
            own = np.flatnonzero(sel == s)
            shift = np.arange(c, dtype=np.uint64) * np.uint64(bits)
            out[at[own][:, None] + np.arange(c)] = words[own][:, None] >> shift & np.uint64((1 << bits) - 1)
    own = (big >= first) & (big < last)
    out[big[own] - first] = escaped[own]
    return out


class Memo:
    """A dictionary in two generations: when the young one is full it becomes the old one, whose
    entries come back when they are asked for and else go."""

    def __init__(self):
        self.young: dict = {}
        self.old: dict = {}

    def turn(self) -> None:
        """To be called between two batches of look-ups."""
        if len(self.young) > MEMO:
            self.young, self.old = {}, self.young

    def missing(self, keys: set) -> list:
        """Of keys that are not young, those that are not old either; the others become young."""
        found = keys.intersection(self.old)
        self.young.update((k, self.old[k]) for k in found)
        return list(keys - found)


def expected(library) -> bool:
    """Whether the tokenizer's file normalises and cuts texts as this module does."""
    told = json.loads(library.to_str())
    told = {**told["model"], **{k: told[k] for k in ("normalizer", "pre_tokenizer", "post_processor")}, "added": [(t["normalized"], t["lstrip"], t["rstrip"], t["single_word"]) for t in told["added_tokens"]]}
    return all(k in told and told[k] == v for k, v in EXPECTED.items()) and not any(any(t) for t in told["added"])


def gathered(codes: np.ndarray, known: list[bytes], lists: np.ndarray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``codes`` into ``known`` one after the other, and how many each list has, which
    ends before ``lists[i + 1]``."""
    size = np.fromiter(map(len, known), np.int64, len(known)) // dtype.itemsize
    flat = np.frombuffer(b"".join(known), dtype)
    each = size[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    shift = (np.cumsum(size) - size)[codes] - ends[:-1]
    ids = flat[np.arange(ends[-1]) + np.repeat(shift, each)]
    return ids, np.diff(ends[lists])


class WordEncoder:
    """Ids of whole texts by remembered pieces. No token of ``word_bpe_49k`` spans white space,
    which the tokenizer drops, or two of the pieces that its pre-tokenizer cuts, so a text's
    ids are its pieces' ids in order. Simple texts (:data:`SIMPLE`) are lower-cased and cut as wholes;
    others word by word, as the library's normaliser leaves the word, words remembered too.
    Pieces not met before go through the library, many to a call; the last token of a piece is
    known by its end mark. Words with special tokens, rare scripts or odd white space go
    through the library whole, and so does everything if the tokenizer's file says something
    else than :data:`EXPECTED`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        self.by_pieces = expected(self.library)
        if not self.by_pieces:
            return
        # the same model for pieces that are normalised and cut: it need not do either again
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join([ODD, *map(re.escape, self.special)]))
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words, self.pieces = Memo(), Memo()

    def pack(self, ids) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def whole(self, words: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.library.encode_batch_fast(words, add_special_tokens=False)] if words else []

    def learn_pieces(self, pieces: list[str]) -> None:
        for i in range(0, len(pieces), 2048):
            part = pieces[i:i + 2048]
            ids = np.array(self.model.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(part):
                flat, at = ids.tobytes(), (cut * self.dtype.itemsize).tolist()
                self.pieces.young.update((p, flat[a:z]) for p, a, z in zip(part, [0, *at], at))
            else:  # not one pre-token each
                self.pieces.young.update(zip(part, self.whole(part)))

    def learn(self, words: list[bytes]) -> None:
        text = b" ".join(words).decode("utf-8", "replace")
        if self.odd.search(text):
            odd = [w for w in words if self.odd.search(w.decode("utf-8", "replace"))]
            self.words.young.update(zip(odd, self.whole([w.decode("utf-8", "replace") for w in odd])))
            apart = set(odd)
            words = [w for w in words if w not in apart]
            text = b" ".join(words).decode()
        if not text.isascii():  # the library's normaliser for these, plain lower case for the others
            words = (narrow := [w for w in words if w.isascii()]) + (wide := [w for w in words if not w.isascii()])
            text = self.library.normalizer.normalize_str(b" ".join(wide).decode())
            if narrow:  # an empty word may be the only one
                text = b" ".join(narrow).decode().lower() + " " + text
        cut = PIECES.findall(text.lower() if text.isascii() else text)
        if cut.count(" ") != max(0, len(words) - 1):
            raise RuntimeError("a word was normalised to several")
        ids = self.ids_of(cut)
        ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat = b"".join(ids)
        stops = ends[[i for i, p in enumerate(cut) if p == " "]].tolist() + [len(flat)]
        self.words.young.update(zip(words, (flat[a:z] for a, z in zip([0, *stops], stops))))

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        """Ids of normalised pieces; those of the space between words are none."""
        self.pieces.turn()
        known = self.pieces.young
        known[" "] = b""
        if (new := {p for p in pieces if p not in known}) and (new := self.pieces.missing(new)):
            self.learn_pieces(new)
        return list(map(known.__getitem__, pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has."""
        texts = texts.fill_null("").cast(pa.large_string())
        if not self.by_pieces:
            ids = [np.array(e.ids, self.dtype) for t in texts.to_pylist() for e in self.library.encode_batch_fast([t], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, self.dtype), *ids]), np.array(list(map(len, ids)), np.int64)
        simple = pc.match_substring_regex(texts, SIMPLE)
        for t in self.special:
            simple = pc.and_not(simple, pc.match_substring(texts, t))
        ids, size = self.encode_simple(texts.filter(simple))
        simple = simple.to_numpy(zero_copy_only=False)
        if simple.all():
            return ids, size
        other, other_size = self.encode_words(texts.filter(pa.array(~simple)))
        each = np.empty(len(texts), np.int64)
        each[simple], each[~simple] = size, other_size
        mine = np.repeat(simple, each)
        out = np.empty(len(mine), self.dtype)
        out[mine], out[~mine] = ids, other
        return out, each

    def encode_simple(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.utf8_lower(texts), CUTS, r" \1 "))
        # splitting leaves empty strings at the ends of a text
        coded = cut.flatten().dictionary_encode()
        return gathered(coded.indices.to_numpy(zero_copy_only=False), self.ids_of([p or " " for p in coded.dictionary.to_pylist()]),
                        cut.offsets.to_numpy() - cut.offsets[0].as_py() if len(cut) else np.zeros(1, np.int64), self.dtype)

    def encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Words are split and numbered in Arrow; only distinct ones are looked up."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = as_bytes(coded.dictionary)
        self.words.turn()
        get = self.words.young.get
        known = list(map(get, words))
        if None in known:
            if new := self.words.missing({w for w, ids in zip(words, known) if ids is None}):
                self.learn(new)
            known = list(map(get, words))
        return gathered(coded.indices.to_numpy(zero_copy_only=False), known, lists.offsets.to_numpy() - lists.offsets[0].as_py(), self.dtype)


def as_bytes(strings: pa.Array) -> list[bytes]:
    """An Arrow string array without nulls as bytes, cut from its one buffer."""
    if not len(strings):
        return []
    kind = np.int64 if pa.types.is_large_string(strings.type) else np.int32
    _, offsets, data = strings.buffers()
    cut = np.frombuffer(offsets, kind)[strings.offset:strings.offset + len(strings) + 1].tolist()
    data = data.to_pybytes() if data is not None else b""
    return [data[a:z] for a, z in zip(cut, cut[1:])]


def portions(batches, most: int = PORTION):
    """(doc_ids, texts) of about ``most`` bytes from batches of whole texts, one text at least."""
    held: list[pa.RecordBatch] = []
    size = 0

    def joined():
        t = pa.Table.from_batches(held).combine_chunks()
        return t.column(0).to_pylist(), t.column(1).combine_chunks()

    for b in batches:
        each = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
        i = 0
        while i < b.num_rows:
            n = int(np.searchsorted(np.cumsum(each[i:]), most - size, side="right"))
            if n == 0 and not held:
                n = 1
            if n:
                held.append(b.slice(i, n))
                size += int(each[i:i + n].sum())
                i += n
            if i < b.num_rows:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One for each worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


RECORD = "shard int, record int, doc_ids array<bigint>, lengths array<bigint>, first bigint, n_ids bigint, payload binary"


def write_shards(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> str:
    """Write the shards of ``docs`` (doc_id, text) to ``path`` and return it."""
    small_batches(docs.sparkSession)

    def run(batches):
        encode = encoder(tokenizer).encode
        shard, record, first = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        doc_ids: list = []
        lengths: list[int] = []
        end = np.array([end_id], np.uint32)
        n = 0

        def flush():
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_pylist([{"shard": shard, "record": record, "doc_ids": doc_ids, "lengths": lengths,
                                                "first": first, "n_ids": len(flat), "payload": encode_ids(flat)}],
                                              schema=pa.schema([("shard", pa.int32()), ("record", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                                                                ("first", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())]))

        for keys, texts in portions(batches):
            flat, size = encode(texts)
            a = 0
            for k, z in zip(keys, np.cumsum(size).tolist()):
                ids += [flat[a:z], end]
                doc_ids.append(k)
                lengths.append(z - a + 1)
                n, a = n + z - a + 1, z
                if n >= RECORD_IDS:
                    yield flush()
                    record, first = record + 1, first + n
                    ids, doc_ids, lengths, n = [], [], [], 0
        if ids:
            yield flush()

    order = [F.col("doc_id").asc_nulls_first(), F.col("__llm_a"), F.col("__llm_b")]
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"), F.xxhash64("text").alias("__llm_a"), pack_hash(docs).alias("__llm_b"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    dealt.mapInArrow(run, RECORD).write.mode("error").option("compression", "zstd").parquet(path)
    return path


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files."""
    records = spark.read.schema(RECORD).parquet(path)
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = (records.groupBy("shard").agg(F.sum("n_ids").alias("__llm_n"))
              .select("shard", F.coalesce(F.sum("__llm_n").over(ahead), F.lit(0)).alias("__llm_before")))
    # one row a shard, so no more than the write had tasks
    rows = records.join(F.broadcast(before), "shard").select("doc_ids", "lengths", (F.col("first") + F.col("__llm_before")).alias("first"), "payload")

    def run(batches):
        for b in batches:
            doc_ids, lengths, firsts, payloads = (b.column(i).to_pylist() for i in range(4))
            for d, n, first, blob in zip(doc_ids, lengths, firsts, payloads):
                ids = decode_ids(blob).astype("<u4")
                end = np.cumsum(n)
                start = end - n
                crc = [zlib.crc32(ids[a:z]) for a, z in zip(start, end)]
                yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(start + first), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                                                 ["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the shards to a new folder in the shared one and read them back."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    return read_shards(spark, write_shards(docs, tokenizer, scratch_path(spark, "llm-shards"), end_id))
