"""Token ids in files of fixed-width packed bits.

A file is a Parquet file of blocks. Each block holds whole documents of one
shard, as ids packed into the fewest bits that the vocabulary needs, lowest bit
first, with the ids and lengths of its documents and its own offset. Shards and
the documents in them ascend by ``doc_id`` (absent ids first; rows that share an
id are ordered by a hash of their text). Null and empty texts are documents of the
end id alone; an empty table gives an empty set of files. Columns other than the
id and the text are not read, whatever their names.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from itertools import accumulate, chain, compress

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faultline.llm.common import slices, table
from faultline.session import cut_lineage, work_dir

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
BLOCK_IDS = 1 << 16
CACHED_WORDS = 800_000
#: How the words of the default tokenizer are cut, and the ASCII marks that are no letter or digit.
_MARK_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_TOKENIZERS: dict[str, "WordTokenizer"] = {}

BLOCK_SCHEMA = "shard int, block int, first long, n_ids long, bits int, doc_ids array<bigint>, lengths array<int>, payload binary"


class WordTokenizer:
    """Encodes texts with a tokenizer that drops white space, each distinct word once.

    No token of such a tokenizer crosses white space, so the ids of a text are
    those of its words in order. About ``cached`` words are kept between texts; words
    beyond them are encoded again in each batch.

    If the tokenizer lower-cases and cuts at the borders of letters and marks, the ids
    of a word that ends in ASCII marks after a letter are those of the word without
    them, then those of the marks; and an ASCII word has the ids of its lower-case form.
    So most forms of a word are put together from one that the tokenizer has seen.
    Words of Latin letters alone are one piece each and go to its merges at once, as
    the bytes that they are written with.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec.get("normalizer") or {}).get("normalizers")
        if steps:  # words come one space apart, so folding white space changes nothing
            spec["normalizer"]["normalizers"] = [s for s in steps if s.get("pattern") != {"Regex": "\\s+"}]
        self.parts = bool(steps) and [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and _cuts_at_marks(spec)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec))
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = [t["content"].encode().lower() for t in spec.get("added_tokens", [])]
        self.limit = cached
        self.known: dict[bytes, bytes] = {}

    def _ask(self, words: list[bytes], into: dict[bytes, bytes]) -> None:
        """The ids of words from the tokenizer itself."""
        for k in range(0, len(words), 2000):
            asked = words[k : k + 2000]
            part = b" ".join(asked).decode("utf-8", "replace").split(" ")
            if self.parts:
                latin = [t.isalpha() and (t.isascii() or not _FAR(t)) for t in part]
                letters = " ".join(compress(part, latin)).lower().encode()
                merge = self.tokenizer.model.tokenize
                ids = [[t.id for t in merge(w)] for w in charmap_decode(letters, "strict", _BYTE_CHARACTERS)[0].split()]
                into.update(zip(compress(asked, latin), _cut(list(chain.from_iterable(ids)), [0, *accumulate(map(len, ids))])))
                asked, part = ([x for x, known in zip(xs, latin) if not known] for xs in (asked, part))
            if asked:
                got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
                starts = np.cumsum([0, *(len(w) + 1 for w in part)])
                into.update(zip(asked, _cut(got.ids, np.searchsorted(np.array([a for a, _ in got.offsets], np.int64), starts).tolist())))

    def _learn(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of words that are not known, and of the parts that they were put together from."""
        known, fresh = self.known, {}
        if not self.parts:
            self._ask(list(words), fresh)
            return fresh
        whole, pairs = set(), []
        marked = b" ".join(words).lower()
        specials = [s for s in self.special if s in marked]
        for word in words:
            plain = word.isascii()
            low = word.lower() if plain else word
            stem = low.rstrip(_MARKS)
            if stem == word or specials and any(s in word.lower() for s in specials):
                whole.add(word)
                continue
            marks = low[len(stem) :]
            if (plain or marks) and marks[:1] != b"'" and (stem[-1:].isalnum() if plain else stem.decode("utf-8", "replace")[-1:].lower()[-1:].isalpha()):
                pairs.append((word, stem, marks))
                whole.add(stem)
                if marks:
                    whole.add(marks)
            else:
                whole.add(word)
        self._ask([w for w in whole if w not in known], fresh)
        for word, stem, marks in pairs:
            ids = known.get(stem)
            ids = fresh[stem] if ids is None else ids
            if marks:
                end = known.get(marks)
                ids += fresh[marks] if end is None else end
            fresh[word] = ids
        return fresh

    def _lowered(self, text: bytes) -> bytes:
        """An ASCII text in lower case, unless that makes or hides a special token."""
        if not self.parts or not text.isascii():
            return text
        low = text.lower()
        return text if any(s in low for s in self.special) else low

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        split = [self._lowered(t).split() for t in texts]
        known = self.known
        fresh = self._learn(set().union(*split).difference(known))
        known.update(fresh)
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        if len(known) > self.limit:
            for word in fresh:
                del known[word]
        return out


def _cut(ids: list[int], starts: list[int]) -> list[bytes]:
    """The ids between each two ``starts`` as bytes."""
    data, cuts = np.array(ids, "<u4").tobytes(), [4 * x for x in starts]
    return [data[x:y] for x, y in zip(cuts[:-1], cuts[1:])]


def _byte_characters() -> str:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on.

    The space is left alone; words stand one space apart.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or b >= 0xA1 and b != 0xAD]
    others = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in plain)}
    return "".join(" " if b == 0x20 else chr(others.get(b, b)) for b in range(256))


_BYTE_CHARACTERS = _byte_characters()
#: Finds a letter that is not Latin, or not composed, or without a lower case of its own (a capital I with a dot).
_FAR = re.compile("[^\0-\u012f\u0131-\u017f]").search


def _cuts_at_marks(spec: dict) -> bool:
    """Whether the words of a tokenizer are cut into contractions, letters, digits, and runs of anything else."""
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    bytewise = len(steps) == 2 and steps[1].get("type") == "ByteLevel" and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
    known = bytewise and (steps[0].get("pattern") or {}).get("Regex") == _MARK_RULE
    return known and not spec.get("post_processor") and sys.byteorder == "little"


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker and file."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of each id, lowest first, without gaps."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a packed block, without reading the others."""
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", count, first * bits // 8).astype(np.uint32)
    low = first * bits // 8
    raw = np.unpackbits(np.frombuffer(payload, np.uint8)[low : ((first + count) * bits + 7) // 8], bitorder="little")
    skip = first * bits - 8 * low
    planes = raw[skip : skip + count * bits].reshape(count, bits).astype(np.uint32)
    return (planes << np.arange(bits, dtype=np.uint32)).sum(1, dtype=np.uint32)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str = TOKENIZER, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Encode every text, append ``end_id`` and write the blocks in ascending order of ``doc_id``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(tokenizer_path)
        bits = max(1, (max(words.vocabulary - 1, end_id)).bit_length())
        end = np.array([end_id], "<u4").tobytes()
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        names: list[int | None] = []
        parts: list[bytes] = []

        def close() -> pa.RecordBatch:
            nonlocal block, first
            ids = np.frombuffer(b"".join(parts), "<u4")
            row = [shard, block, first, len(ids), bits, names.copy(), [len(p) // 4 for p in parts], pack(ids, bits)]
            block, first = block + 1, first + len(ids)
            names.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], columns)

        held = 0
        for part in slices(batches):
            for name, ids in zip(part.column(0).to_pylist(), words.encode([t or b"" for t in part.column(1).to_pylist()])):
                names.append(name)
                parts.append(ids + end)
                held += len(ids) // 4 + 1
                if held >= block_ids:
                    yield close()
                    held = 0
        if names:
            yield close()

    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
    columns = ["shard", "block", "first", "n_ids", "bits", "doc_ids", "lengths", "payload"]
    order = [F.col("doc_id"), F.xxhash64("text")]
    (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(encode, BLOCK_SCHEMA)
        .write.parquet(path)
    )


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a set of token files with ``start``, the number of ids before each."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    offsets = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start")
    )
    return blocks.join(F.broadcast(offsets), "shard").withColumn(  # one row for each task that wrote
        "start", F.col("shard_start") + F.col("first")
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, 1):
            start, bits, names, lengths, payload = (c[0].as_py() for c in block.columns)
            at = np.concatenate([[0], np.cumsum(lengths)])
            ids = unpack(payload, bits, 0, int(at[-1])).astype("<u4")
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(start + at[:-1]), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    blocks = read_blocks(spark, path).select("start", "bits", "doc_ids", "lengths", "payload")
    return blocks.mapInArrow(cut, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of the whole set, from the blocks that hold them only."""
    wanted = read_blocks(spark, path).where((F.col("start") < first + count) & (F.col("start") + F.col("n_ids") > first))
    out = np.zeros(count, np.uint32)
    for b in wanted.select("start", "n_ids", "bits", "payload").toLocalIterator():
        low, high = max(first, b.start), min(first + count, b.start + b.n_ids)
        out[low - first : high - first] = unpack(bytes(b.payload), b.bits, low - b.start, high - low)
    return out


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the token files of ``docs`` to the shared folder, read their documents back and delete the files."""
    spark = docs.sparkSession
    path = work_dir(spark, "tokens")
    write_token_files(docs, path)
    documents = cut_lineage(read_documents(spark, path))
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return documents
