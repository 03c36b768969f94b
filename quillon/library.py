"""A library on disk: the stored catalog of subscriptions, their tables, and the versions of their schemas."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillon import catalog
from quillon.catalog import Subscription
from quillon.operators.upsert import ParquetStore
from quillon.types import DATA_TYPES, DataTypeSpec


@dataclass(frozen=True)
class Migration:
    """A numbered change of one record type's stored schema.

    ``apply`` takes a stored table with the schema before and gives it with the schema after; ``schema`` is the latter.
    """

    number: int
    name: str
    data_type: str
    schema: T.StructType
    apply: Callable[[DataFrame], DataFrame]


class Library:
    """Subscriptions with their tables below one folder.

    ``root/catalog`` is a store with one row a subscription, ``root/tables/<name>`` the store of each of its record types.
    A subscription exists once its catalog row does, and that row is written last: a save that fails before leaves
    tables that nothing names, and saving again takes them over.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        rows = catalog.as_rows(spark, [])
        updates = tuple(c for c in rows.columns if c != "subscription_id")
        self._catalog = ParquetStore(spark, f"{self.root}/catalog", DataTypeSpec("subscription", rows.schema, ("subscription_id",), update=updates))

    def catalog(self) -> DataFrame:
        return self._catalog.read()

    def save(self, subscription: Subscription) -> Subscription:
        """Create the subscription's tables and then its row; without an id it gets a new one.

        A known id is an error, so that counters are never overwritten.
        """
        s = subscription if subscription.subscription_id else replace(subscription, subscription_id=str(uuid.uuid4()))
        if unknown := [k for k in s.data_types if k not in DATA_TYPES]:
            raise ValueError(f"unknown record types {unknown}")
        rows = catalog.as_rows(self.spark, [s])
        if not self.catalog().where(F.col("subscription_id") == s.subscription_id).isEmpty():
            raise ValueError(f"subscription {s.subscription_id} exists")
        for r in catalog.tables(rows).collect():
            self._store(r["table_name"], r["data_type"]).create()
        self._catalog.merge(rows)
        return s

    def set_active(self, id_: str, active: bool) -> None:
        self._catalog.merge(catalog.set_active(self.catalog().where(F.col("subscription_id") == id_), id_, active))

    def drop(self, id_: str) -> None:
        """Delete the subscription's row, then its tables."""
        gone = catalog.tables(self.catalog().where(F.col("subscription_id") == id_)).collect()
        self._catalog.replace(catalog.drop(self.catalog(), id_))
        for r in gone:
            store = self._store(r["table_name"], r["data_type"])
            store._fs().delete(store._path(store.root), True)

    def stores(self, id_: str) -> dict[str, ParquetStore]:
        """The store of each record type of a subscription."""
        rows = catalog.tables(self.catalog().where(F.col("subscription_id") == id_)).collect()
        return {r["data_type"]: self._store(r["table_name"], r["data_type"]) for r in rows}

    def count(self, id_: str, security: str = "composite_figi", day: str = "event_date") -> None:
        """Bring the counters of a subscription up to its stored rows; types without such columns count rows only."""
        parts = [
            st.read().select(F.lit(id_).alias("id"), *[(F.col(c) if c in st.spec.schema.names else F.lit(None)).cast(t).alias(n) for n, c, t in (("s", security, "string"), ("d", day, "timestamp_ntz"))])
            for st in self.stores(id_).values()
        ]
        if not parts:
            return
        whole = parts[0]
        for p in parts[1:]:
            whole = whole.unionByName(p)
        fresh = catalog.counters(whole, F.col("id"), F.col("s"), F.col("d"))
        row = self.catalog().where(F.col("subscription_id") == id_)
        self._catalog.merge(row.drop(*[c for c in fresh.columns if c != "subscription_id"]).join(fresh, "subscription_id").select(*row.columns))

    # --- schemas -----------------------------------------------------------------------------------------------------

    def applied(self, table: str) -> tuple[int, T.StructType | None]:
        """Number of the last migration of a table (0 if none) and the schema that it left."""
        fs = self._catalog._fs()
        folder = self._catalog._path(f"{self.root}/tables/{table}/schema")
        numbers = sorted(int(x.getPath().getName()[:-5]) for x in fs.listStatus(folder) if x.getPath().getName()[:-5].isdigit()) if fs.exists(folder) else []
        if not numbers:
            return 0, None
        text = self.spark.read.text(f"{self.root}/tables/{table}/schema/{numbers[-1]}.json", wholetext=True).first()[0]
        return numbers[-1], T.StructType.fromJson(json.loads(text))

    def migrate(self, steps: Sequence[Migration], upto: int | None = None) -> list[tuple[str, int]]:
        """Apply to every table the steps of its type that it lacks, in the order of their numbers; returns those applied.

        A step rewrites a table as its next version and then records its number and schema. A table whose version already
        has the step's columns only lacks the record (a run stopped between the two), so it is not rewritten again.
        """
        if len({(s.data_type, s.number) for s in steps}) != len(steps):
            raise ValueError("two steps of a type have one number")
        done = []
        for r in catalog.tables(self.catalog()).orderBy("table_name").collect():
            for step in sorted((s for s in steps if s.data_type == r["data_type"]), key=lambda s: s.number):
                last, _ = self.applied(r["table_name"])
                if step.number <= last or (upto is not None and step.number > upto):
                    continue
                before = self._store(r["table_name"], r["data_type"])
                after = ParquetStore(self.spark, before.root, replace(before.spec, schema=step.schema))
                n, state = before._newest()
                if state.get("schema_number", 0) < step.number:
                    after.replace(step.apply(before.read()).select(*step.schema.names), schema_number=step.number)
                self._record(r["table_name"], step)
                done.append((r["table_name"], step.number))
        return done

    def _record(self, table: str, step: Migration) -> None:
        fs = self._catalog._fs()
        out = fs.create(self._catalog._path(f"{self.root}/tables/{table}/schema/{step.number}.json"), True)
        out.write(bytearray(step.schema.json().encode()))
        out.close()

    def _store(self, table: str, data_type: str) -> ParquetStore:
        _, schema = self.applied(table)
        spec = DATA_TYPES[data_type]
        return ParquetStore(self.spark, f"{self.root}/tables/{table}", spec if schema is None else replace(spec, schema=schema))
