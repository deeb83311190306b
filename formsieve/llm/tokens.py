"""Token ids of all documents in one binary array, with Elias-Fano encoded document boundaries.

A shard file holds, little-endian:

    magic "EFTOK1\\0\\0" | header: 8 x u64 (documents, tokens, bytes per id, lowest id, span of ids, null ids, low bits of
    boundaries, low bits of ids) | boundaries | document ids | token ids

Boundaries are the documents' end positions, a rising sequence; the document ids are one too, as shards are in id order. Both
are Elias-Fano coded: the low bits of each value side by side, and the high parts in unary, n ones among n + (max >> low)
bits, so about 2 + log2(max / n) bits per document replace a 64-bit table. A sampled select directory (position of each
256th one) finds the i-th value without reading the rest.
"""
from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, folder_for, local_path, materialize

MAGIC = b"EFTOK1\0\0"
HEADER = 8
SAMPLE = 256
#: Documents that are read in one piece.
READ = 512
#: Parts of words whose ids a worker remembers (some 300 bytes each), words that are looked up together, and parts per call of
#: the tokenizer.
REMEMBER, TOGETHER, CALL = 600_000, 300_000, 20_000
#: Signs that are cut off behind a letter.
SIGNS = "!\"#$%&()*+,-./:;=?@[]^_`{|}~"
LOWER_BYTES = np.frombuffer(LOWER, np.uint8)
#: Signs of which the tokenizer has to know one as a token of its own; it stands between words that are encoded together.
MARKS = "☃★♥♪✨☀▶"


class EliasFano:
    """A non-decreasing sequence of unsigned integers with random access."""

    def __init__(self, n: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.low, self.lows, self.highs, self.samples = n, low, lows, highs, samples

    @staticmethod
    def low_bits(n: int, top: int) -> int:
        return max(0, (top // max(n, 1)).bit_length() - 1)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low = cls.low_bits(n, top)
        ones = (values >> np.uint64(low)).astype(np.int64) + np.arange(n)
        bits = np.zeros((top >> low) + n + 1, np.uint8)
        bits[ones] = 1
        shifts = np.arange(low, dtype=np.uint64)
        lows = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        return cls(n, low, lows, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype(np.uint32 if len(bits) < 1 << 32 else np.uint64))

    def to_bytes(self) -> bytes:
        parts = [self.lows.tobytes(), self.highs.tobytes(), self.samples.astype("<u8").tobytes()]
        return np.array([len(p) for p in parts], "<u8").tobytes() + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview, at: int, n: int, low: int) -> tuple[EliasFano, int]:
        sizes = np.frombuffer(data, "<u8", 3, at).astype(np.int64)
        ends = at + 24 + np.cumsum(sizes)
        lows, highs = (np.frombuffer(data, np.uint8, int(s), int(e - s)) for s, e in zip(sizes[:2], ends[:2]))
        samples = np.frombuffer(data, "<u8", int(sizes[2]) // 8, int(ends[1]))
        return cls(n, low, lows, highs, samples), int(ends[2])

    def select(self, i: int) -> int:
        """The i-th value: from the sampled one before it, over at most a few bytes per value."""
        at = int(self.samples[i // SAMPLE])
        left, byte = i % SAMPLE, at >> 3
        if left:
            word = int(self.highs[byte]) & (0xFF << (at & 7))
            left += 1
            while left > (ones := word.bit_count()):
                left -= ones
                byte += 1
                word = int(self.highs[byte])
            for _ in range(left - 1):
                word &= word - 1
            at = byte * 8 + (word & -word).bit_length() - 1
        low, first = 0, i * self.low
        for k in range(self.low):
            low |= int(self.lows[(first + k) >> 3] >> ((first + k) & 7) & 1) << k
        return (at - i << self.low) | low

    def values(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Values first to last - 1, decoded together."""
        last = self.n if last is None else last
        if first >= last:
            return np.zeros(0, np.uint64)
        begin = int(self.samples[first // SAMPLE])
        stop = int(self.samples[-(-last // SAMPLE)]) if -(-last // SAMPLE) < len(self.samples) else len(self.highs) * 8
        bits = np.unpackbits(self.highs[begin // 8:-(-stop // 8)], bitorder="little")
        bits[:begin % 8] = 0
        ones = np.flatnonzero(bits)[first % SAMPLE:first % SAMPLE + last - first] + begin // 8 * 8
        high = (ones - np.arange(first, last)).astype(np.uint64)
        if not self.low:
            return high
        span = np.unpackbits(self.lows[first * self.low // 8:-(-last * self.low // 8)], bitorder="little")
        cut = first * self.low % 8
        lows = span[cut:cut + (last - first) * self.low].reshape(-1, self.low).astype(np.uint64)
        return (high << np.uint64(self.low)) | (lows << np.arange(self.low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _parts(words: pa.LargeStringArray) -> pa.LargeStringArray:
    """Of each word two parts: the word in lower case without the ASCII signs behind its last letter, and those signs. A word
    that may hold a special token or a short form ('s) stays as it is, with empty signs. The parts are cuts of one buffer."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    begin, size = offsets[:-1] - offsets[0], np.diff(offsets)
    kept = pc.or_(pc.match_substring(words, "<"), pc.match_substring(words, "'")).to_numpy(zero_copy_only=False)
    low = np.where(np.repeat(kept, size), data, LOWER_BYTES[data])
    plain = pc.binary_length(pc.ascii_rtrim(words, characters=SIGNS)).to_numpy()
    last = low[begin + np.maximum(plain, 1) - 1] if len(low) else np.zeros(len(words), np.uint8)
    cut = ~kept & (plain > 0) & (last >= 97) & (last <= 122)
    bounds = np.zeros(2 * len(words) + 1, np.int64)
    bounds[1::2], bounds[2::2] = begin + np.where(cut, plain, size), begin + size
    return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(bounds), pa.py_buffer(low))


def _joined(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The runs of `count` elements from `begin` on, one after another."""
    ends = np.cumsum(count)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - count), count)]


class Encoder:
    """Ids of whole texts from a tokenizer whose tokens never span white space: distinct words are encoded once and kept.

    A word in capitals, or with signs behind its last letter, is made from what it is without them and from the signs: the
    tokenizer lowers case, and it cuts between a letter and a sign. What is kept are these parts. Arrow finds the distinct
    words and parts of many texts together, so that Python sees each of them once.

    The tokenizer's own normalizer and splitter see every word as it stands; a text that holds white space which the
    tokenizer knows and byte splitting does not is merely a longer word.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.mark, self.mark_id = next(((c, ids[0]) for c in MARKS if len(ids := self.tokenizer.encode(c, add_special_tokens=False).ids) == 1), ("", -1))
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool) if suffix else None
        for token, number in vocabulary.items() if suffix else ():
            self.ends[number] = token.endswith(suffix)
        self.known = {"": 0}
        self.flat, self.at, self.used = np.zeros(0, np.uint32), np.zeros(2, np.int64), np.zeros(1, bool)

    def _forget(self) -> None:
        """Drop parts that did not come back since the last time; if nearly all did, drop all but the empty one."""
        slots = np.fromiter(self.known.values(), np.int64, len(self.known))
        kept = self.used[slots]
        if kept.mean() > 0.6:
            kept[:] = False
        kept[0] = True
        names = [w for w, k in zip(self.known, kept.tolist()) if k]
        begin = self.at[slots[kept]]
        count = self.at[slots[kept] + 1] - begin
        self.flat = _joined(self.flat, begin, count)
        self.at, self.known = np.concatenate(([0], np.cumsum(count))), dict(zip(names, range(len(names))))
        self.used = np.zeros(len(names), bool)

    def learn(self, parts: list[str]) -> None:
        """Encode parts that are new."""
        made = [self._together(parts[i:i + CALL]) for i in range(0, len(parts), CALL)]
        base = len(self.known)
        self.flat = np.concatenate([self.flat, *(m[0] for m in made)])
        self.at = np.concatenate((self.at, self.at[-1] + np.cumsum(np.concatenate([m[1] for m in made]))))
        self.known.update(zip(parts, range(base, base + len(parts))))
        self.used = np.concatenate((self.used, np.zeros(len(parts), bool)))

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words and their numbers. The words go through the tokenizer as few texts.

        A word of letters is one piece of text to the tokenizer, which marks the token that ends a piece: so the ids of many
        show where each ends. Between other words stands a sign that is a token of its own.
        """
        simple = [w.isalpha() for w in words] if self.ends is not None else [False] * len(words)
        letters = [w for w, s in zip(words, simple) if s]
        made = self._ids([" ".join(letters[i:i + 500]) for i in range(0, len(letters), 500)])
        last = np.flatnonzero(self.ends[made]) if letters else np.zeros(0, np.int64)
        if len(last) != len(letters):
            return self._marked(words)
        if len(letters) == len(words):
            return made, np.diff(np.concatenate(([-1], last)))
        rest, rest_sizes = self._marked([w for w, s in zip(words, simple) if not s])
        sizes, simple = np.zeros(len(words), np.int64), np.array(simple)
        sizes[simple], sizes[~simple] = np.diff(np.concatenate(([-1], last))), rest_sizes
        of_simple = np.repeat(simple, sizes)
        ids = np.zeros(len(of_simple), np.uint32)
        ids[of_simple], ids[~of_simple] = made, rest
        return ids, sizes

    def _ids(self, texts: list[str]) -> np.ndarray:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in made)])

    def _marked(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = [w if self.mark and self.mark not in w else "" for w in words]
        made = self._ids([f" {self.mark} ".join(plain[i:i + 500]) + f" {self.mark}" for i in range(0, len(plain), 500)])
        marks = np.flatnonzero(made == self.mark_id)
        flat, sizes = np.delete(made, marks), np.diff(np.concatenate(([-1], marks))) - 1
        if len(sizes) == len(words) and all(plain):
            return flat, sizes
        found = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) if not p or len(sizes) != len(words) else None
                 for w, p in zip(words, plain)]
        cut = np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) == len(words) else [None] * len(words)
        found = [c if f is None else f for f, c in zip(found, cut)]
        return np.concatenate(found), np.array([len(f) for f in found], np.int64)

    def encode(self, texts: pa.Array | Iterable[bytes | None], end_id: int) -> list[np.ndarray]:
        """One id array per text, its end id included."""
        column = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.large_string())
        split = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
        words, bounds = split.values, split.offsets.to_numpy()
        parts = [self._sized(words.slice(i, TOGETHER)) for i in range(0, len(words), TOGETHER)]
        ids = np.concatenate([np.zeros(0, np.uint32), *(p[0] for p in parts)])
        ends = np.concatenate(([0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)]))))[bounds].tolist()
        return [np.append(ids[a:b], np.uint32(end_id)) for a, b in zip(ends[:-1], ends[1:])]

    def _sized(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has."""
        coded = words.dictionary_encode()
        parts = _parts(coded.dictionary).dictionary_encode()
        slots = self._slots(parts.dictionary.to_numpy(zero_copy_only=False).tolist())[parts.indices.to_numpy()]
        begin = self.at[slots]
        count = self.at[slots + 1] - begin
        flat, ends = _joined(self.flat, begin, count), np.concatenate(([0], np.cumsum(count)[1::2]))
        at = coded.indices.to_numpy()
        sizes = ends[at + 1] - ends[at]
        return _joined(flat, ends[at], sizes), sizes

    def _slots(self, parts: list[str]) -> np.ndarray:
        """Where the ids of each part stand; those of new ones are made."""
        slots = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(slots < 0)
        if len(new):
            if len(self.known) > REMEMBER:
                self._forget()
                slots = np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))
                new = np.flatnonzero(slots < 0)
            slots[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.learn([parts[i] for i in new.tolist()])
        self.used[slots] = True
        return slots


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def shard_bytes(ids: list[int | None], lengths: list[int], width: int) -> bytes:
    """Everything of a shard file that precedes its token ids."""
    named = np.array([i for i in ids if i is not None], np.int64)
    lowest = int(named[0]) if len(named) else 0
    bounds = EliasFano.encode(np.cumsum(np.array(lengths, np.uint64)))
    names = EliasFano.encode(named.astype(np.uint64) - np.uint64(lowest & (2**64 - 1)))
    header = np.array([len(ids), sum(lengths), width, lowest & (2**64 - 1), len(named), len(ids) - len(named), bounds.low, names.low], "<u8")
    return MAGIC + header.tobytes() + bounds.to_bytes() + names.to_bytes()


def _write(folder: str, tokenizer: str, end_id: int, width: int, limit: int):
    """Write a partition's documents, which are in id order, as shard files of at least `limit` tokens; list the files.

    A file's name is new in every attempt of a task, and only the attempt that Spark accepts lists it, so that a lost
    executor leaves at most unlisted files behind.
    """
    kind = f"<u{width}"

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        store, root = local_path(folder)
        store.create_dir(root, recursive=True)
        partition, encode, part = TaskContext.get().partitionId(), encoder(tokenizer), 0
        ids, arrays, total = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{root}/{partition:06d}-{part:04d}-{uuid.uuid4().hex}.eftok"
            with store.open_output_stream(name, compression=None) as out:
                out.write(shard_bytes(ids, [len(a) for a in arrays], width))
                for a in arrays:
                    out.write(a.astype(kind).tobytes())
            return pa.RecordBatch.from_pydict({"shard": [(partition << 32) + part], "file": [name], "n_docs": [len(ids)], "n_tokens": [total]})

        for batch in stream:
            for key, array in zip(batch.column(0).to_pylist(), encode.encode(batch.column(1), end_id)):
                ids.append(key)
                arrays.append(array)
                total += len(array)
                if total >= limit:
                    yield flush()
                    ids, arrays, total, part = [], [], 0, part + 1
        if ids:
            yield flush()
    return run


class Shard:
    """A shard file, its structures loaded and its token ids read on demand."""

    def __init__(self, source) -> None:
        self.source = source
        head = source.read(len(MAGIC) + 8 * HEADER)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        self.n_docs, self.n_tokens, self.width, lowest, named, self.nulls, low, id_low = np.frombuffer(head, "<u8", HEADER, len(MAGIC)).tolist()
        self.tokens_at = source.size() - self.n_tokens * self.width
        rest = memoryview(source.read(self.tokens_at - len(head)))
        self.bounds, at = EliasFano.from_bytes(rest, 0, self.n_docs, low)
        self.names, _ = EliasFano.from_bytes(rest, at, named, id_low)
        self.lowest = np.uint64(lowest)

    def doc_ids(self, first: int = 0, last: int | None = None) -> list[int | None]:
        last = self.n_docs if last is None else last
        named = self.names.values(max(first - self.nulls, 0), max(last - self.nulls, 0)) + self.lowest
        return [None] * (min(last, self.nulls) - min(first, self.nulls)) + named.astype(np.int64).tolist()

    def block(self, first: int, last: int) -> tuple[list[int | None], np.ndarray, list[int]]:
        """Ids, boundaries (one more) and checksums of the documents first to last - 1; what they hold is read in one piece."""
        begin, end = self.bounds.select(first - 1) if first else 0, self.bounds.select(last - 1)
        bounds = np.concatenate(([begin], self.bounds.values(first, last).astype(np.int64)))
        held = memoryview(self.tokens(begin, end).astype("<u4").tobytes())
        return self.doc_ids(first, last), bounds, [zlib.crc32(held[4 * (a - begin):4 * (b - begin)]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def ends(self) -> np.ndarray:
        return self.bounds.values().astype(np.int64)

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document, by two selects."""
        return self.tokens(self.bounds.select(i - 1) if i else 0, self.bounds.select(i))

    def tokens(self, first: int, last: int) -> np.ndarray:
        self.source.seek(self.tokens_at + first * self.width)
        return np.frombuffer(self.source.read((last - first) * self.width), f"<u{self.width}")


def encode(docs: DataFrame, tokenizer: str, end_id: int, vocabulary: int, id_col: str = "doc_id", text_col: str = "text",
           shards: int | None = None, tokens_per_file: int = 1 << 26) -> DataFrame:
    """Write all documents in ascending id order; returns the manifest (file, n_docs, n_tokens, start), a row per file.

    `start` counts the ids in all files before. Null ids come first, a null text has its end id alone, rows with one id keep
    an order by the hash of their text, repeated rows are written again. No rows give no file. Ids take two bytes if the
    vocabulary allows it. Other columns are ignored.
    """
    folder = folder_for(docs.sparkSession, "tokens")
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    count = shards or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = rows.repartitionByRange(count, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    files = materialize(ordered.mapInArrow(_write(folder, tokenizer, end_id, width, tokens_per_file), "shard long, file string, n_docs long, n_tokens long"))
    return with_starts(files)


def with_starts(files: DataFrame) -> DataFrame:
    """Running token counts over the files, through blocks of 1024 partitions: the one window over all holds a row a block."""
    marked = files.withColumn("block", F.shiftright("shard", 32 + 10))
    upto = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = marked.groupBy("block").agg(F.sum("n_tokens").alias("t")).select("block", F.coalesce(F.sum("t").over(upto), F.lit(0)).alias("base"))
    before = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return marked.withColumn("inner", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).join(base, "block").select(
        "shard", "file", "n_docs", "n_tokens", (F.col("base") + F.col("inner")).alias("start"))


def read_back(manifest: DataFrame) -> DataFrame:
    """(id, start, n_tokens, crc32) of every document, decoded from the files of a manifest, block by block: two selects find
    where a block's ids begin and end, so a file is never decoded whole. A null id is null again, a document written twice is
    read twice; no files give no rows, and other columns of the manifest are ignored."""
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("crc32", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name, base in zip(*(c.to_pylist() for c in batch.columns)):
                store, path = local_path(name)
                with store.open_input_file(path) as source:
                    shard = Shard(source)
                    for first in range(0, shard.n_docs, READ):
                        ids, starts, crcs = shard.block(first, min(first + READ, shard.n_docs))
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts[:-1] + base), pa.array(np.diff(starts)),
                                                          pa.array(crcs, pa.int64())], schema=schema)

    files = manifest.select("file", "start")
    tasks = max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism))  # a row here is a file's work: not to be coalesced
    return files.repartition(tasks, "file").mapInArrow(run, "id long, start long, n_tokens long, crc32 long")
