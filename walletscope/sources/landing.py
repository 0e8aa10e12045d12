"""Landing zone of transaction pages as a Spark data source, for batch reads and streams.

Pages land in numbered drops: ``<root>/drop=<number>/of=<buckets>/bucket=<bucket>/*.parquet``. A bucket holds whole
wallets and its files are sorted by the last lt of their pages, so a read of one wallet opens one bucket
per drop, and a read after a cursor skips by the files' statistics. A drop counts once Spark has marked it
written; a drop that died half-way is not there, and one that is there is not written again.

The stream's offset is the number of the last drop it has read. A cursor per wallet would grow with the
wallets and travel through the driver; wallets have theirs in the checkpoint table
(``operators.ingest.fetch_after_checkpoint``). A batch takes all drops since the one before, in whole.

Defined results
- Pages that fail as a whole have no ``last_lt``; they are read like others, but by no filter on ``last_lt``.
- NULL wallet parts are kept. Repeated pages stay repeated. An empty drop counts as a drop without rows.
- A root without drops, or without a folder, is an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition,
)
from pyspark.sql.types import StructType

from walletscope import params
from walletscope.schemas import WALLET
from walletscope.sources.pages import PAGE_FILE, transactions, with_transactions

NAME = "wallet_pages"
PAGE = f"{PAGE_FILE}, last_lt bigint"
_COLUMNS = ["chain", "provider", "address", "body", "last_lt"]
_BATCH_ROWS = 256  # pages are texts of up to a hundred transactions


def _place(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a root and the path in it."""
    if root.startswith("file:"):
        root = "/" + root[len("file:"):].lstrip("/")
    if "://" in root:
        return fs.FileSystem.from_uri(root)
    return fs.LocalFileSystem(), root


def _folder(drop: int) -> str:
    return f"drop={drop:010d}"


def _is_whole(files: fs.FileSystem, path: str, drop: int) -> bool:
    return files.get_file_info(f"{path}/{_folder(drop)}/_SUCCESS").type == fs.FileType.File


def land(pages: DataFrame, root: str, drop: int, buckets: int = 64) -> None:
    """Write pages (chain, provider, address, body) as one drop.

    Rows are dealt by ranges of (bucket, last lt), so the pages of a hot wallet are cut into several files.
    """
    if _is_whole(*_place(root), drop):
        return
    last = F.array_max(F.transform("txs", lambda t: t["lt"]))
    wallet = F.concat_ws(":", *WALLET).cast("binary")
    rows = with_transactions(pages).select("chain", "provider", "address", "body", last.alias("last_lt"),
                                           F.lit(buckets).alias("of"), F.pmod(F.crc32(wallet), F.lit(buckets)).alias("bucket"))
    (rows.repartitionByRange("bucket", "last_lt").sortWithinPartitions("bucket", "last_lt")
     .write.mode("overwrite").option("maxRecordsPerFile", 100_000).partitionBy("of", "bucket")
     .parquet(f"{root}/{_folder(drop)}"))


def read_landed(spark: SparkSession, root: str) -> DataFrame:
    """All pages of all whole drops."""
    spark.dataSource.register(WalletPages)
    return spark.read.format(NAME).load(root)


def stream_landed(spark: SparkSession, root: str) -> DataFrame:
    """Drops as they land, in the order of their numbers; a missing one holds back those behind it."""
    spark.dataSource.register(WalletPages)
    return spark.readStream.format(NAME).load(root)


def fetch_after(spark: SparkSession, root: str, chain: str, address: str, provider: str, lt: int | None,
                limit: int = params.FETCH_LIMIT) -> DataFrame:
    """The wallet's next transactions after a cursor (NULL: from the start), by lt and hash, at most ``limit``."""
    mine = read_landed(spark, root).where(
        (F.col("chain") == chain) & (F.col("address") == address) & (F.col("provider") == provider))
    if lt is None:
        return transactions(mine).orderBy("lt", "tx_hash").limit(limit)
    later = transactions(mine.where(F.col("last_lt") > lt)).where(F.col("lt") > lt)
    return later.orderBy("lt", "tx_hash").limit(limit)


@dataclass
class PageFile(InputPartition):
    """One file of a drop, and what a page in it must fulfil: the wallet's parts, and the lt behind which it ends."""

    path: str
    wallet: dict[str, str]
    after: int | None = None


def _files(root: str, drops: Iterable[int], wallet: dict[str, str], after: int | None = None) -> list[PageFile]:
    """The files that can hold the wallet, or all files if a part of it is not given."""
    files, path = _place(root)
    name = ":".join(wallet[c] for c in WALLET).encode() if set(wallet) == set(WALLET) else None
    found = []
    for drop in drops:
        for of in files.get_file_info(fs.FileSelector(f"{path}/{_folder(drop)}")):
            if of.type != fs.FileType.Directory or not of.base_name.startswith("of="):
                continue
            at = of.path if name is None else f"{of.path}/bucket={zlib.crc32(name) % int(of.base_name[3:])}"
            inside = files.get_file_info(fs.FileSelector(at, allow_not_found=True, recursive=True))
            found += [PageFile(f.path, wallet, after) for f in inside if f.is_file and f.extension == "parquet"]
    return sorted(found, key=lambda f: f.path)


def _pages(root: str, part: PageFile) -> Iterator[pa.RecordBatch]:
    """The pages of a file, some hundred at a time."""
    files, _ = _place(root)
    wanted = [ds.field(c) == v for c, v in part.wallet.items()]
    if part.after is not None:
        wanted.append(ds.field("last_lt") > part.after)
    match = None
    for one in wanted:
        match = one if match is None else match & one
    read = ds.dataset(part.path, format="parquet", filesystem=files)
    yield from read.to_batches(columns=_COLUMNS, filter=match, batch_size=_BATCH_ROWS, batch_readahead=1, fragment_readahead=1)


class WalletPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return PAGE

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(self.options["path"])

    def streamReader(self, schema: StructType) -> PageStream:
        return PageStream(self.options["path"])


class PageReader(DataSourceReader):
    """Whole drops; equality on the wallet and lower bounds of ``last_lt`` reach the files."""

    def __init__(self, root: str):
        self.root = root
        self.wallet: dict[str, str] = {}
        self.after: int | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Filters are used to skip; Spark applies all of them again."""
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute[0] in WALLET:
                self.wallet.setdefault(f.attribute[0], f.value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("last_lt",):
                least = f.value if isinstance(f, GreaterThan) else f.value - 1
                self.after = least if self.after is None else max(self.after, least)
            yield f

    def partitions(self) -> Sequence[InputPartition]:
        files, path = _place(self.root)
        landed = files.get_file_info(fs.FileSelector(path, allow_not_found=True))
        numbers = [int(f.base_name[5:]) for f in landed if f.base_name.startswith("drop=")]
        whole = [n for n in sorted(numbers) if _is_whole(files, path, n)]
        return _files(self.root, whole, self.wallet, self.after) or [PageFile("", {})]

    def read(self, partition: PageFile) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from _pages(self.root, partition)


class PageStream(DataSourceStreamReader):
    def __init__(self, root: str):
        self.root = root
        self.last = -1  # every drop up to here is whole

    def initialOffset(self) -> dict:
        return {"drop": -1}

    def latestOffset(self) -> dict:
        files, path = _place(self.root)
        while _is_whole(files, path, self.last + 1):
            self.last += 1
        return {"drop": self.last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return _files(self.root, range(start["drop"] + 1, end["drop"] + 1), {})

    def read(self, partition: PageFile) -> Iterator[pa.RecordBatch]:
        yield from _pages(self.root, partition)
