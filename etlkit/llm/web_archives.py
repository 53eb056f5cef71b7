"""Web archives (WARC): writing, a globally ordered capture index, reading back.

Each task writes records to archive files in the given folder, every record a gzip member of
its own, and lists the captures of a file as one run in the order of URL key and time.
The runs are then dealt to ranges of (URL key, time), and each range is merged from its runs by
a loser tree, so the index as a whole is in order. Records are read at the places the index
names.

Of payloads that are equal and have at least ``LEAST_REVISIT`` bytes one is kept: the
record of the largest page id is the response, the others are revisit records without payload.

The folder must be one that all executors reach, on a file system that pyarrow knows. A file's
name holds a random part, and only files whose run was committed are named in the index, so
repeated and lost tasks leave unread files at most.

Cases: a null html is an empty payload; a null url has an empty key and no target; a null
page id is smaller than any other; rows of one page id are separate records, and of
quite equal rows any one is the response; an empty table gives an empty index; other columns
are ignored; payloads of any length are written whole.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit
from uuid import UUID, uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from etlkit.llm.common import pick, slices
from etlkit.operators.reuse import staged
from etlkit.operators.sizing import broadcast_if_small, shuffle_partitions

LEAST_REVISIT = 1000
# A file is closed when it holds so many bytes; its captures are one run.
FILE_BYTES = 128 << 20
# Pages without a time are dated from here, a second for each page id.
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
_YEARS = 10 * 365 * 86400

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RUN = pa.schema([
    ("run", pa.string()), ("place", pa.int64()), ("url_key", pa.string()), ("time", pa.string()),
    ("row", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
_RUN_DDL = "run string, place long, url_key string, time string, row long, offset long, length long"
_RECORD = "row long, page_id long, record_type string, payload_bytes long, payload_digest string, refers_row long"


def url_key(url: str | None) -> str:
    """A key that sorts captures of one host together: reversed host, then path and query."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    name = ",".join(reversed(host.split("."))) + (f":{port}" if port not in (None, 80, 443) else "")
    return f"{name}){parts.path.lower() or '/'}" + (f"?{parts.query.lower()}" if parts.query else "")


def file_system(folder: str) -> tuple[fs.FileSystem, str]:
    system, path = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
    return system, path.rstrip("/")


def _one_line(text: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _name(row: int) -> str:
    return f"<urn:uuid:{UUID(int=row)}>"


def _write(folder: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        stream, captures, name, size = None, [], "", 0

        def closed() -> pa.RecordBatch:
            stream.close()
            captures.sort(key=lambda c: (c["url_key"], c["time"], c["row"]))
            rows = [{"run": name, "place": i, **c} for i, c in enumerate(captures)]
            captures.clear()
            return pa.RecordBatch.from_pylist(rows, _RUN)

        for batch in slices(batches, "html"):
            for row in batch.to_pylist():
                if stream is None:
                    name, size = f"{TaskContext.get().partitionId():06d}-{uuid4().hex}.warc.gz", 0
                    stream = system.open_output_stream(f"{path}/{name}", compression=None)
                payload = (row["html"] or "").encode()
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                revisit = row["refers_row"] is not None
                fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _name(row["row"])),
                          ("WARC-Date", row["time"]), ("WARC-Payload-Digest", f"sha1:{digest}"),
                          ("Content-Type", "application/http; msgtype=response")]
                if row["url"]:
                    fields.append(("WARC-Target-URI", _one_line(row["url"])))
                if row["page_id"] is not None:
                    fields.append(("X-Page-ID", str(row["page_id"])))
                if revisit:
                    fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(row["refers_row"]))]
                answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                data = _record(fields, answer.encode() + (b"" if revisit else payload))
                stream.write(data)
                captures.append({"url_key": url_key(row["url"]), "time": row["time"], "row": row["row"],
                                 "offset": size, "length": len(data)})
                size += len(data)
                if size >= file_bytes:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    return run


def merged(runs: list[list]) -> Iterator[tuple[int, int]]:
    """(run, place) of all keys of sorted runs in ascending order, by a loser tree.

    Inner nodes hold the run that lost there; a run that gives a key plays again only on its
    way up, so each key costs one comparison per level.
    """
    k = len(runs)
    heads = [0] * k

    def beats(a: int, b: int) -> bool:
        if a < 0 or heads[a] >= len(runs[a]):
            return False
        if b < 0 or heads[b] >= len(runs[b]):
            return True
        return runs[a][heads[a]] <= runs[b][heads[b]]

    losers = [-1] * k
    winners = [-1] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if beats(a, b) else (b, a)
    winner = winners[1] if k > 1 else 0
    for _ in range(sum(map(len, runs))):
        yield winner, heads[winner]
        heads[winner] += 1
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range of the index from its parts of runs, which come one after the other."""
    table = pa.Table.from_batches(list(batches), _RUN)
    if not table.num_rows:
        return
    names = table["run"].to_pylist()
    keys = list(zip(*(table[c].to_pylist() for c in ("url_key", "time", "row"))))
    starts = [i for i in range(len(names)) if not i or names[i] != names[i - 1]]
    runs = [keys[a:b] for a, b in zip(starts, [*starts[1:], len(names)])]
    order = [starts[run] + place for run, place in merged(runs)]
    table = table.take(pa.array(order)).set_column(1, "place", pa.array(range(len(order)), pa.int64()))
    yield from table.to_batches(max_chunksize=10_000)


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url",
                   html: str = "html", time: str | None = None, file_bytes: int = FILE_BYTES) -> None:
    """Write all pages as records to ``folder/archives`` and their index to ``folder/index``.

    The index is Parquet: ``part`` and ``place`` give the global order, ``run`` the file of
    a capture, ``offset`` and ``length`` its bytes there. Runs jobs.
    """
    spark = pages.sparkSession
    columns = {"page_id": page_id, "url": url, "html": html} | ({"at": time} if time else {})
    rows = pick(pages, **columns).withColumn("page_id", F.col("page_id").cast("long"))
    if time:
        text = F.date_format(F.coalesce(F.col("at").cast("timestamp"), F.lit(START)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    else:
        moment = F.lit(int(START.timestamp())) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(_YEARS))
        text = F.date_format(F.timestamp_seconds(moment), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # Rows get a number that stays: the copy written here is what both later passes read.
    rows = staged(rows.select(F.monotonically_increasing_id().alias("row"), "page_id", "url", "html",
                              text.alias("time")), "pages")
    large = rows.filter(F.octet_length("html") >= LEAST_REVISIT).select("row", "page_id", F.sha1(F.col("html").cast("binary")).alias("digest"))
    kept = F.max(F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_id"), "row")).alias("kept")
    copied = large.groupBy("digest").agg(kept, F.count(F.lit(1)).alias("n")).filter("n > 1")
    revisits = staged(large.join(copied, "digest").filter("row != kept.row").select(
        "row", F.col("kept.row").alias("refers_row")), "revisits")
    system, path = file_system(folder)
    system.create_dir(f"{path}/archives", recursive=True)
    runs = staged(rows.join(broadcast_if_small(revisits), "row", "left").mapInArrow(
        _write(f"{folder}/archives", file_bytes), _RUN_DDL), "runs")
    keys = ["url_key", "time", "row"]
    dealt = runs.repartitionByRange(shuffle_partitions(runs), *keys).sortWithinPartitions("run", "place")
    dealt.mapInArrow(_merge, _RUN_DDL).withColumn("part", F.spark_partition_id()).write.parquet(f"{folder}/index")


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The captures; (``part``, ``place``) is the order of URL key and time."""
    return spark.read.schema(f"{_RUN_DDL}, part int").parquet(f"{folder}/index")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, block) of one record."""
    stream = io.BytesIO(zlib.decompress(data, 31))
    if stream.readline() != b"WARC/1.1\r\n":
        raise ValueError("not a WARC record")
    fields = {}
    while (line := stream.readline()) not in (b"\r\n", b""):
        key, _, value = line.decode().rstrip("\r\n").partition(": ")
        fields[key] = value
    return fields, stream.read(int(fields["Content-Length"]))


def _row_of(name: str) -> int:
    return UUID(name.strip("<>")).int


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = file_system(folder)
        name, file = None, None
        for batch in batches:
            out = []
            for run_name, offset, length in zip(*(batch[c].to_pylist() for c in ("run", "offset", "length"))):
                if run_name != name:
                    if file:
                        file.close()
                    name, file = run_name, system.open_input_file(f"{path}/{run_name}")
                fields, block = parse(file.read_at(length, offset))
                payload = block.partition(b"\r\n\r\n")[2]
                response = fields["WARC-Type"] == "response"
                digest = hashlib.sha1(payload).hexdigest() if response else base64.b32decode(
                    fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                out.append({
                    "row": _row_of(fields["WARC-Record-ID"]),
                    "page_id": int(fields["X-Page-ID"]) if "X-Page-ID" in fields else None,
                    "record_type": fields["WARC-Type"], "payload_bytes": len(payload) if response else None,
                    "payload_digest": digest,
                    "refers_row": None if response else _row_of(fields["WARC-Refers-To"])})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("row", pa.int64()), ("page_id", pa.int64()), ("record_type", pa.string()),
                ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_row", pa.int64())]))
        if file:
            file.close()

    return run


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives, read from the files: ``page_id, payload_bytes,
    payload_digest, record_type, refers_to``. A revisit's payload is that of the response
    it refers to."""
    captures = index(spark, folder)
    dealt = captures.select("run", "offset", "length").repartition(shuffle_partitions(captures), "run") \
        .sortWithinPartitions("run", "offset")
    records = staged(dealt.mapInArrow(_read(f"{folder}/archives"), _RECORD), "records")
    responses = records.filter("refers_row IS NULL")
    whole = responses.select(
        F.col("row").alias("refers_row"), F.col("payload_bytes").alias("bytes"), F.col("page_id").alias("refers_to"))
    revisits = records.filter("refers_row IS NOT NULL").join(whole, "refers_row")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.withColumn("refers_to", F.lit(None).cast("long")).select(columns).union(
        revisits.withColumn("payload_bytes", F.col("bytes")).select(columns))
