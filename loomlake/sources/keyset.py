"""A stream over a table that grows: rows in the order of a cursor column and an id, each delivered once.

    spark.dataSource.register(KeysetSource)
    spark.readStream.format("keyset").options(path=.., cursor="ts", id="event_id").schema(..).load()

The position is that of the incremental reads in cursors.py: the last (cursor, id). It is kept by the checkpoint, so a
query that starts again reads no row twice. Rows without a cursor value have a position of their own, by id. Positions
are found in the statistics of Parquet row groups; the cursor and id columns are read only of groups that can hold the last
row, or that have rows without a cursor. A partition of a batch is a row group that overlaps its range.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

_EPOCH = datetime.datetime(1970, 1, 1)
Position = tuple | None


@dataclass
class RowGroup(InputPartition):
    """A row group, and the positions (cursor, id) and (id) after which and up to which its rows are wanted."""

    file: str
    group: int
    after: Position
    upto: Position
    after_undated: object
    upto_undated: object

    def __init__(self, *args):
        self.file, self.group, self.after, self.upto, self.after_undated, self.upto_undated = args


class KeysetSource(DataSource):
    """Options: path (a Parquet file or folder), cursor, id (a column without nulls that is unique among equal cursors)."""

    @classmethod
    def name(cls) -> str:
        return "keyset"

    def schema(self) -> StructType | str:
        raise ValueError("give the table's schema with .schema()")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return KeysetReader(self.options["path"], self.options["cursor"], self.options["id"], schema.names)


def _plain(x):
    """A value that JSON keeps: times as whole microseconds."""
    if isinstance(x, datetime.datetime):
        return (x.replace(tzinfo=None) - _EPOCH) // datetime.timedelta(microseconds=1)
    return x


class KeysetReader(DataSourceStreamReader):
    def __init__(self, path: str, cursor: str, id_col: str, columns: list[str]):
        self.path, self.cursor, self.id, self.columns = path, cursor, id_col, columns

    def initialOffset(self) -> dict:
        return {"cursor": "null", "id": "null", "undated": "null"}

    def latestOffset(self) -> dict:
        last, undated = None, None
        groups = [(f, g, m) for f, g, m in self._groups()]
        tops = [m["cursor"][1] for *_, m in groups if m["cursor"]]
        top = max(tops, default=None)
        for file, group, m in groups:
            may_be_last = m["rows"] > m["nulls"] and (m["cursor"] is None or top is None or m["cursor"][1] >= top)
            if not may_be_last and not m["nulls"]:
                continue
            table = self._open(file).read_row_group(group, [self.cursor, self.id])
            dated = table.filter(pc.is_valid(table[self.cursor]))
            if may_be_last and len(dated):
                one = dated.take(pc.sort_indices(dated, [(self.cursor, "descending"), (self.id, "descending")])[:1])
                here = (_plain(one[self.cursor][0].as_py()), one[self.id][0].as_py())
                last = here if last is None else max(last, here)
            rest = table.filter(pc.is_null(table[self.cursor]))
            if len(rest):
                here = pc.max(rest[self.id]).as_py()
                undated = here if undated is None else max(undated, here)
        say = json.dumps
        return {"cursor": say(last[0] if last else None), "id": say(last[1] if last else None), "undated": say(undated)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        (a, na), (b, nb) = self._position(start), self._position(end)
        out = []
        for file, group, m in self._groups():
            span = m["cursor"]
            dated = b is not None and a != b and m["rows"] > m["nulls"] and (span is None or (span[0] <= b[0] and (a is None or span[1] >= a[0])))
            undated = nb is not None and na != nb and m["nulls"] > 0
            if dated or undated:
                out.append(RowGroup(file, group, a, b if dated else None, na, nb if undated else None))
        return out

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        table = self._open(partition.file).read_row_group(partition.group, list(dict.fromkeys([*self.columns, self.cursor, self.id])))
        raw, key = table[self.cursor], table[self.id]
        cursor = pc.cast(pc.cast(raw, pa.timestamp("us")), pa.int64()) if pa.types.is_timestamp(raw.type) else raw
        wanted = pa.array([False] * len(table))
        if partition.upto is not None:
            wanted = _upto(cursor, key, partition.upto)
            if partition.after is not None:
                wanted = pc.and_(wanted, pc.invert(_upto(cursor, key, partition.after)))
            wanted = pc.fill_null(wanted, False)
        if partition.upto_undated is not None:
            none = pc.and_(pc.is_null(raw), pc.less_equal(key, partition.upto_undated))
            if partition.after_undated is not None:
                none = pc.and_(none, pc.greater(key, partition.after_undated))
            wanted = pc.or_(wanted, pc.fill_null(none, False))
        yield from table.filter(wanted).select(self.columns).to_batches()

    def _position(self, offset: dict) -> tuple[Position, object]:
        cursor, key, undated = (json.loads(offset[k]) for k in ("cursor", "id", "undated"))
        return (None if cursor is None else (cursor, key)), undated

    def _store(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)

    def _open(self, file: str) -> pq.ParquetFile:
        return pq.ParquetFile(file, filesystem=self._store()[0])

    def _groups(self) -> Iterator[tuple[str, int, dict]]:
        """Files' row groups with their rows, rows without a cursor, and least and largest cursor where that is stated."""
        store, path = self._store()
        info = store.get_file_info(path)
        files = [path] if info.is_file else sorted(f.path for f in store.get_file_info(pafs.FileSelector(path, recursive=True)) if f.is_file and f.path.endswith(".parquet") and not f.base_name.startswith(("_", ".")))
        for file in files:
            meta = self._open(file).metadata
            at = [i for i in range(meta.num_columns) if meta.row_group(0).column(i).path_in_schema == self.cursor][0] if meta.num_row_groups else 0
            for g in range(meta.num_row_groups):
                column, rows = meta.row_group(g).column(at), meta.row_group(g).num_rows
                s = column.statistics
                nulls = s.null_count if s is not None and s.has_null_count else rows
                span = (_plain(s.min), _plain(s.max)) if s is not None and s.has_min_max else None
                yield file, g, {"rows": rows, "nulls": min(nulls, rows), "cursor": span}


def _upto(cursor, key, position: tuple):
    """Whether rows come at or before a position."""
    at = pa.scalar(position[0], cursor.type)
    return pc.or_(pc.less(cursor, at), pc.and_(pc.equal(cursor, at), pc.less_equal(key, pa.scalar(position[1], key.type))))
