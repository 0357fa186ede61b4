"""Tables kept in cells that micro-batches replace one by one.

A store holds one or more tables, each cut into cells by a few partition columns (a key bucket, a chunk of the
sequence). A micro-batch writes new copies of the cells it touches into a folder of its epoch and then commits: one
small table names, for every cell, the epoch whose copy counts. Readers and later batches open exactly the folders
they ask for -- no listing of all epochs, no cell read that isn't asked for.

* Atomic: a commit covers all tables of the store; a reader sees the state before or after it. A batch that dies before
  its commit leaves the last state as it was, and its replay writes the same folder again. A batch that was committed
  already is recognised (``committed``) and must not be applied again.
* Bounded: what a commit replaces stays for readers of the state before it and is deleted by the next commit. The
  commit table has one row a cell; it is the only thing the driver holds.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetspark.session import names_in, remove_path

NO_EPOCH = -1
EPOCH = "_epoch"
COMMIT = "name string, cell array<string>, written long, replaced long"


class KeyedStore:
    """``cells``: the partition columns of each table, by the table's name. Their values are integers or strings that
    need no escaping in a path."""

    def __init__(self, spark: SparkSession, root: str, cells: Mapping[str, Sequence[str]]):
        self.spark, self.root, self.cells = spark, root.rstrip("/"), {t: list(c) for t, c in cells.items()}
        self._known: tuple[int, list] | None = None

    # --- commits ------------------------------------------------------------------------------------------------------
    def _commits(self) -> list[int]:
        """Epochs with a commit, newest first: the last two and at most a few that their writer had no time to remove."""
        root = f"{self.root}/commits"
        found = [n for n in names_in(self.spark, root) if n.startswith("epoch=")]
        # A commit is one file, so it is there as a whole or not at all.
        return sorted((int(n[6:]) for n in found if any(x.startswith("part-") for x in names_in(self.spark, f"{root}/{n}"))), reverse=True)

    def _state(self) -> tuple[int, list]:
        """The last committed epoch and its rows, as they were when this object first asked (or committed)."""
        if self._known is None:
            epochs = self._commits()
            rows = []
            if epochs:
                rows = self.spark.read.schema(COMMIT).parquet(f"{self.root}/commits/epoch={epochs[0]}").where(F.col("name").isNotNull()).collect()
            self._known = (epochs[0] if epochs else NO_EPOCH, rows)
        return self._known

    def committed(self, epoch: int) -> bool:
        return self._state()[0] >= epoch

    def live(self, table: str) -> dict[tuple[str, ...], int]:
        """Of each cell the epoch that wrote its current copy."""
        return {tuple(r.cell): r.written for r in self._state()[1] if r.name == table and r.replaced is None}

    # --- reading ------------------------------------------------------------------------------------------------------
    def _folder(self, table: str, epoch: int) -> str:
        return f"{self.root}/data/{table}/{EPOCH}={epoch}"

    def _path(self, table: str, epoch: int, cell: Sequence[str]) -> str:
        return "/".join([self._folder(table, epoch), *[f"{c}={v}" for c, v in zip(self.cells[table], cell, strict=False)]])

    def schema(self, table: str) -> StructType:
        """Columns of a table that has rows, without those of its cells."""
        cell, epoch = next(iter(self.live(table).items()))
        return self.spark.read.parquet(self._path(table, epoch, cell)).schema

    def read(self, table: str, schema: StructType | None = None, cells: Iterable[Sequence] | None = None, written: Mapping[tuple, int] | None = None) -> DataFrame:
        """Rows of the given cells (or of all whose leading columns are given), with the cell columns as strings. ``written``: copies that are
        not committed yet count before the committed ones."""
        wanted = None if cells is None else {tuple(str(v) for v in c) for c in cells}
        current = {**self.live(table), **(written or {})}
        chosen = {c: e for c, e in current.items() if wanted is None or any(c[:k] in wanted for k in range(len(c) + 1))}
        full = self.schema(table) if schema is None else schema
        for c in self.cells[table]:
            if c not in full.names:
                full = StructType([*full.fields]).add(c, "string")
        if not chosen:
            return self.spark.createDataFrame([], full)
        paths = [self._path(table, e, c) for c, e in chosen.items()]
        reader = self.spark.read.schema(StructType([*full.fields]).add(EPOCH, "long")).option("basePath", f"{self.root}/data/{table}")
        return reader.parquet(*paths).drop(EPOCH)

    def select(self, table: str) -> str:
        """SQL for the table's committed rows, without the columns of its cells: a view of this state (a later commit
        needs a new one; the commit after it deletes the files)."""
        paths = [self._path(table, e, c).removeprefix(f"{self.root}/") for c, e in sorted(self.live(table).items())]
        names = ", ".join(f"`{n}`" for n in self.schema(table).names)
        at = paths[0] if len(paths) == 1 else "{" + ",".join(paths) + "}"
        return f"SELECT {names} FROM parquet.`{self.root}/{at}`"

    # --- writing ------------------------------------------------------------------------------------------------------
    def write(self, table: str, epoch: int, rows: DataFrame) -> dict[tuple[str, ...], int]:
        """New copies of the cells that ``rows`` has; returns them for ``commit`` (and for reads before it)."""
        folder, names = self._folder(table, epoch), self.cells[table]
        if names:  # the rows of a cell meet before they are written: files follow the cells, not tasks times cells
            rows = rows.hint("rebalance", *names)
        rows.write.mode("overwrite").partitionBy(*names).parquet(folder)
        cells = [()]
        for name in names:  # a folder level each
            inside = ((c, n) for c in cells for n in names_in(self.spark, self._path(table, epoch, c)))
            cells = [(*c, n.partition("=")[2]) for c, n in inside if n.startswith(f"{name}=")]
        return dict.fromkeys(cells, epoch)

    def commit(self, epoch: int, written: Mapping[str, Mapping[tuple, int]], replaced: Mapping[str, Iterable[Sequence]] | None = None) -> None:
        """``written``: by table, what ``write`` returned. ``replaced``: further cells whose rows are gone."""
        last, rows = self._state()
        keep, remove = [], []
        for r in rows:
            cell = tuple(r.cell)
            if r.replaced is not None:
                remove.append(self._path(r.name, r.written, cell))  # nobody reads the state before the last one
            elif cell in written.get(r.name, {}) or cell in {tuple(map(str, c)) for c in (replaced or {}).get(r.name, ())}:
                keep.append((r.name, list(cell), r.written, epoch))
            else:
                keep.append((r.name, list(cell), r.written, None))
        keep += [(t, list(cell), epoch, None) for t, cells in written.items() for cell in cells]
        keep = keep or [(None, None, None, None)]
        self.spark.createDataFrame(keep, COMMIT).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/epoch={epoch}")
        self._known = None
        for path in remove:
            remove_path(self.spark, path)
        for old in self._commits()[1:]:
            if old != last:
                remove_path(self.spark, f"{self.root}/commits/epoch={old}")
