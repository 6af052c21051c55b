"""Several tables that change together: one commit record makes a batch's writes visible, all or none.

    <root>/<table>/<attempt>/<key>=<value>/...   what an attempt wrote, Parquet
    <root>/commits/<number>.json                 the batch, and for each table which attempts hold each key value

A batch writes its tables into folders of its own and then puts one small record in place; a reader follows the newest
record. So a job that stops between two writes has changed nothing, one that runs again under the same batch name does
nothing, and of two that run at once one fails. Key values are dates, buckets or parts: few beside the rows, as a record
lists them. Old files stay, for readers that still follow an older record, until `clean`.
"""
from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom import files


@dataclass(frozen=True)
class Write:
    """Rows for one table. `replace`: they take the place of what their key values held; else they are added.

    `emptied`: key values that lose what they held before the rows are put in.
    """
    rows: DataFrame
    replace: bool = False
    emptied: tuple = ()


class Ledger:
    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str]):
        self.spark, self.root, self.keys = spark, root, keys

    def _record(self) -> dict:
        done = [n for n in files.names(self.spark, os.path.join(self.root, "commits")) if n.endswith(".json")]
        if not done:
            return {"number": 0, "batches": [], "tables": {}}
        return json.loads(files.read_text(self.spark, os.path.join(self.root, "commits", done[-1])))

    def batches(self) -> list[str]:
        return self._record()["batches"]

    def values(self, table: str) -> list[str]:
        """The key values that hold rows."""
        return sorted(self._record()["tables"].get(table, {"places": {}})["places"])

    def read(self, table: str, only: list | None = None) -> DataFrame | None:
        """The committed rows, or those of some key values; None where the table was never written.

        Only the files of these key values are listed and read.
        """
        known = self._record()["tables"].get(table)
        if known is None:
            return None
        schema = T.StructType.fromJson(known["schema"])
        wanted = known["places"] if only is None else {v: known["places"][v] for v in map(str, only) if v in known["places"]}
        key = self.keys[table]
        parts = [self.spark.read.schema(schema).option("basePath", base).parquet(*[os.path.join(base, f"{key}={v}") for v in values])
                 for base, values in self._by_attempt(table, wanted).items()]
        if not parts:
            return self.spark.createDataFrame([], schema)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.select(*schema.fieldNames())

    def _by_attempt(self, table: str, places: dict[str, list[str]]) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {}
        for value, attempts in places.items():
            for attempt in attempts:
                out.setdefault(os.path.join(self.root, table, attempt), []).append(value)
        return out

    def commit(self, batch: str, writes: dict[str, Write], after_write=lambda table: None) -> bool:
        """Write the tables and make them visible together; False, writing nothing, where the batch is committed.

        `after_write` is called with each table that has been written, before anything is visible.
        """
        record = self._record()
        if batch in record["batches"]:
            return False
        attempt = f"{record['number'] + 1:08d}-{uuid.uuid4().hex}"
        tables = dict(record["tables"])
        for table, write in writes.items():
            key, folder = self.keys[table], os.path.join(self.root, table, attempt)
            write.rows.write.partitionBy(key).parquet(folder)
            after_write(table)
            new = [n.removeprefix(key + "=") for n in files.names(self.spark, folder) if n.startswith(key + "=")]
            places = dict(tables.get(table, {"places": {}})["places"])
            for value in map(str, write.emptied):
                places.pop(value, None)
            for value in new:
                places[value] = [attempt] if write.replace else [*places.get(value, []), attempt]
            tables[table] = {"places": places, "schema": json.loads(write.rows.schema.json())}
        fresh = {"number": record["number"] + 1, "batches": [*record["batches"], batch], "tables": tables}
        if not files.create_text(self.spark, os.path.join(self.root, "commits", f"{fresh['number']:08d}.json"), json.dumps(fresh)):
            raise RuntimeError(f"another job has committed while batch {batch} was written; nothing of it is visible")
        return True

    def clean(self) -> None:
        """Delete what the newest record does not name, older records too. Run it when nobody reads or writes."""
        record = self._record()
        for table in self.keys:
            named = {a for attempts in record["tables"].get(table, {"places": {}})["places"].values() for a in attempts}
            for attempt in files.names(self.spark, os.path.join(self.root, table)):
                if attempt not in named:
                    files.delete(self.spark, os.path.join(self.root, table, attempt))
        for name in files.names(self.spark, os.path.join(self.root, "commits"))[:-1]:
            files.delete(self.spark, os.path.join(self.root, "commits", name))
