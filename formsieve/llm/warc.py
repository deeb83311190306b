"""WARC archives of web pages with payload deduplication, and their capture index by external merge.

Every writing task leaves compressed archives and one locally sorted run of captures. The runs are merged by URL key and time:
a merge task takes one key range of up to `FAN_IN` runs and plays their heads off in a loser tree, so that it holds a batch
of each run and nothing else; more runs than that take several passes. Ranges are drawn from a sample of whole keys (URL key,
time, page), so a URL with most of the captures is split by time. The result is globally ordered, file after file.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import folder_for, local_path, materialize

#: Compressed bytes of an archive file, runs a merge task opens, captures of a merge task.
ARCHIVE_BYTES, FAN_IN, MERGE_ROWS = 256 << 20, 64, 1 << 15
FIELDS = ["urlkey", "ts", "page_id", "file", "offset", "length"]
CAPTURES = "urlkey string, ts string, page_id long, file string, offset long, length long"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: str | None) -> str:
    """Sort-friendly key: host labels reversed, lower case, no `www.`, scheme, default port or fragment. Null and odd URLs
    keep what they have."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    place = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{place}){parts.path.lower() or '/'}" + (f"?{parts.query.lower()}" if parts.query else "")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", mtime=0)


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_record(page_id: int | None, url: str | None, ts: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or, with `refers_to`, a revisit record: HTTP headers alone, with the payload's true length."""
    date = f"{ts[:4]}-{ts[4:6]}-{ts[6:8]}T{ts[8:10]}:{ts[10:12]}:{ts[12:]}Z" if ts else "0001-01-01T00:00:00Z"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "about:blank")
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Target-URI", target),
              ("WARC-Date", date), ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        return _record([*fields, ("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)], http)
    return _record(fields, http + payload)


def read_record(data: bytes) -> dict:
    """Type, page, payload length and digest, and the page a revisit refers to; a response's payload is measured itself."""
    raw = gzip.decompress(data)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = lambda name: int(found[1]) if (found := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(re.search(rb"Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (base32_sha1(payload) != digest or len(payload) != size):
        raise ValueError("payload and digest differ")
    return {"page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To")}


def roles(pages: DataFrame, id_col: str, url_col: str, payload_col: str, time_col: str, least_bytes: int) -> DataFrame:
    """(page_id, url, ts, html, refers_to): what each page's record says. Of equal payloads of at least `least_bytes`, the
    smallest page is the response, and so is every row that repeats its id; null ids come last."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.date_format(time_col, "yyyyMMddHHmmss").alias("ts"),
                        F.coalesce(F.col(payload_col), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    equal = rows.where(F.octet_length("html") >= least_bytes).groupBy("digest").agg(F.min("page_id").alias("least"), F.count(F.lit(1)).alias("n"))
    shared = materialize(equal.where("n > 1 and least is not null").select("digest", "least"))
    return rows.join(shared, "digest", "left").select("page_id", "url", "ts", "html", F.when(~F.col("page_id").eqNullSafe(F.col("least")), F.col("least")).alias("refers_to"))


def _write(folder: str, limit: int):
    """Archive files of a partition and their captures. File names are new in every attempt; what no capture names is void."""
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        store, root = local_path(folder)
        store.create_dir(root, recursive=True)
        task, part, out, name, at = TaskContext.get().partitionId(), 0, None, "", 0
        try:
            for batch in stream:
                made = []
                for page_id, url, ts, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or at >= limit:
                        if out is not None:
                            out.close()
                        name = f"{folder}/{task:06d}-{part:04d}-{uuid.uuid4().hex}.warc.gz"
                        out, part = store.open_output_stream(f"{root}/{name.rpartition('/')[2]}", compression=None), part + 1
                        info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", "2020-01-01T00:00:00Z"),
                                        ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                        out.write(info)
                        at = len(info)
                    record = page_record(page_id, url, ts, html.encode(), refers_to)
                    out.write(record)
                    made.append((url_key(url), ts or "", page_id, name, at, len(record)))
                    at += len(record)
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=FIELDS)
        finally:
            if out is not None:
                out.close()
    return run


class LoserTree:
    """Merges sorted iterators: inner nodes keep the loser of their match, so a new head replays one path of log2(k) matches."""

    def __init__(self, sources: list[Iterator[tuple]]) -> None:
        self.sources, self.k = sources, len(sources)
        self.heads = [next(s, None) for s in sources]
        self.losers = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._replay(i)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) < (y, b))

    def _replay(self, winner: int) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0:  # first match of this node: wait here for the other side
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (head := self.heads[self.losers[0]]) is not None:
            yield head
            at = self.losers[0]
            self.heads[at] = next(self.sources[at], None)
            self._replay(at)


def _key(row: tuple) -> tuple:
    urlkey, ts, page_id, file, offset, length = row
    return urlkey, ts, page_id is not None, page_id or 0, file, offset, length


def _range_of(run: list[str], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """Captures of a run (its files in order) from `low` up to `high`, a batch in memory at a time."""
    for name in run:
        store, path = local_path(name)
        with store.open_input_file(path) as source:
            file = pq.ParquetFile(source)
            for group in range(file.num_row_groups):
                seen = file.metadata.row_group(group).column(0).statistics
                if seen is not None and seen.has_min_max and (low and seen.max < low[0] or high and seen.min > high[0]):
                    continue
                for batch in file.iter_batches(2048, row_groups=[group]):
                    for row in zip(*(batch.column(f).to_pylist() for f in FIELDS)):
                        key = _key(row)
                        if high is not None and key >= high:
                            return
                        if low is None or key >= low:
                            yield key


def _merge(tasks: list[tuple[list[list[str]], tuple | None, tuple | None]]):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for number in batch.column(0).to_pylist():
                runs, low, high = tasks[number]
                made = []
                for key in LoserTree([_range_of(r, low, high) for r in runs]):
                    made.append(key)
                    if len(made) == 4096:
                        yield _rows(made)
                        made = []
                if made:
                    yield _rows(made)
    return run


def _rows(keys: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*((u, t, p if named else None, f, o, n) for u, t, named, p, f, o, n in keys))]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], names=FIELDS)


def _files(spark: SparkSession, folder: str) -> list[str]:
    """Part files of a written table, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(str(f.getPath().toString()) for f in found if f.getPath().getName().startswith("part-"))


def merge_runs(spark: SparkSession, folder: str, rows_per_task: int = MERGE_ROWS, fan_in: int = FAN_IN) -> tuple[str, DataFrame]:
    """Merge the sorted runs (part files) in `folder`; returns the folder of the globally ordered index and its table.

    The driver holds file names and the bounds of the ranges, not captures.
    """
    table = spark.read.schema(CAPTURES).parquet(folder)
    runs = [[name] for name in _files(spark, folder)]
    total = table.count()
    ranges = max(1, -(-total // rows_per_task))
    step = max(1, total // (ranges * 32))
    drawn = table.where(F.pmod(F.xxhash64("file", "offset"), F.lit(step)) == 0).select(*FIELDS).collect() if ranges > 1 else []
    keys = sorted(_key(tuple(r)) for r in drawn)
    bounds = [None, *dict.fromkeys(keys[len(keys) * i // ranges] for i in range(1, ranges) if keys), None]
    while True:
        groups = [runs[i:i + fan_in] for i in range(0, len(runs), fan_in)] or [[]]
        tasks = [(group, low, high) for group in groups for low, high in zip(bounds, bounds[1:])]
        target = folder_for(spark, "index")
        spark.range(0, len(tasks), 1, len(tasks)).mapInArrow(_merge(tasks), CAPTURES).write.parquet(target)
        if len(groups) == 1:
            return target, spark.read.schema(CAPTURES).parquet(target)
        width = len(bounds) - 1
        runs = [[] for _ in groups]
        for name in _files(spark, target):
            runs[int(re.search(r"part-(\d+)", name)[1]) // width].append(name)


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", time_col: str = "captured_at", least_bytes: int = 0,
            archive_bytes: int = ARCHIVE_BYTES, rows_per_task: int = MERGE_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """Write all pages to archives; returns the index (urlkey, ts, page_id, file, offset, length), ordered over its files.

    A null payload is empty, a null URL has an empty key, a null time sorts first, a null id makes a record without a page.
    Repeated rows are archived again. No rows give an empty index. Other columns are ignored.
    """
    spark = pages.sparkSession
    runs, store = folder_for(spark, "runs"), folder_for(spark, "warc")
    written = roles(pages, id_col, url_col, payload_col, time_col, least_bytes).mapInArrow(_write(store, archive_bytes), CAPTURES)
    written.sortWithinPartitions("urlkey", "ts", "page_id", "file", "offset").write.parquet(runs)
    return merge_runs(spark, runs, rows_per_task, fan_in)[1]


def read_back(index: DataFrame) -> DataFrame:
    """(urlkey, ts, page_id, payload_bytes, payload_digest, record_type, refers_to) of every capture, from the archives.

    Captures of an archive are read together, in file order; responses are checked against their digest.
    """
    schema = pa.schema([("urlkey", pa.string()), ("ts", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = "", None
        for batch in stream:
            made = []
            for urlkey, ts, file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != opened:
                    if source is not None:
                        source.close()
                    store, path = local_path(file)
                    opened, source = file, store.open_input_file(path)
                source.seek(offset)
                made.append({"urlkey": urlkey, "ts": ts} | read_record(source.read(length)))
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=schema)
        if source is not None:
            source.close()

    archives = index.select("file").distinct().count()
    tasks = max(1, min(archives, 4 * index.sparkSession.sparkContext.defaultParallelism))  # a row here is a record's work: not to be coalesced
    by_file = index.select("urlkey", "ts", "file", "offset", "length").repartition(tasks, "file").sortWithinPartitions("file", "offset")
    return by_file.mapInArrow(run, "urlkey string, ts string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
