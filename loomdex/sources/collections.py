"""Named collections of points as tables of Spark's catalog.

A collection is a view with properties. Its properties hold the configuration and name the tables of the current build:
points, vocabulary, token statistics, value ranges, and the ids that the statistics cover. A job that changes more than the
points writes new tables first and then replaces the view, in one statement of the catalog: whoever reads sees the
old build or the new one, and a job that breaks off at any step leaves the old one as it was. Tables that no view names
any more are dropped after the next change, the last build's a change later, for searches that still read them.

Catalog and tables are Spark's: with a metastore, collections outlast the session. Spark's in-memory catalog ends with
the session; :meth:`Collections.restore` enters a build's tables again from their folders.
"""

from __future__ import annotations

import builtins
import hashlib
import json
import re
import uuid
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomdex.functions.embedding import DENSE_SIZE, pack_vector, unpack_vector
from loomdex.functions.vectors import vector_prefix
from loomdex.operators.retrieval import bounds_dict, code_column, unit_prefix
from loomdex.session import written

PAYLOAD_FIELDS = ["geschaeft_uid", "dokument_uid", "url", "title", "beschluss", "text"]
PREFIXES = (64, 128, 256)
QUANTISED = (64, 128)
BOUNDS_SCHEMA = "prefix int, low double, high double"
#: Tables of counted ids that are merged into one when there are more.
COUNTED_TABLES = 8
PROPERTY = "loomdex"


def payload_type(fields: Sequence[str] = PAYLOAD_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


class CollectionExists(ValueError):
    pass


class CollectionMissing(KeyError):
    pass


def _encoded(state: dict) -> str:
    """As hex digits: Spark shows no property whose value has words such as url in it."""
    return json.dumps(state).encode().hex()


def _decoded(value: str) -> dict:
    return json.loads(bytes.fromhex(value))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def weighed(present: Column | str, vocabulary: Sequence[tuple[int, int, float]]) -> Column:
    """Packed weights of a whole vocabulary (idx, slot, idf), in its order, from the packed slots that a point has."""
    to, values = np.full(len(vocabulary), -1), np.zeros(len(vocabulary))
    for idx, slot, idf in vocabulary:
        if slot >= 0:
            to[slot], values[slot] = idx, idf

    @F.arrow_udf(T.BinaryType())
    def weigh(batch: pa.Array) -> pa.Array:
        out = []
        for packed in batch.to_pylist():
            row = np.zeros(len(values))
            if packed:
                at = np.frombuffer(packed, "<i4")
                row[to[at]] = values[at]
            out.append(row.astype("<f8").tobytes())
        return pa.array(out, pa.binary())

    return weigh(present)


class Collections:
    """Create, list, drop, append to and read the collections of one database, whose tables lie below ``root``.

    Points are partitioned by the first ``bucket_chars`` characters of their id, so that fetching the payload
    of a few hits reads a few partitions only. Vectors are packed into bytes, which a scan reads several
    times faster than arrays; :meth:`read` gives arrays back. The longest prefix is stored beside the whole vector, which
    lets a coarse-to-fine search skip the wide column; shorter prefixes are cut from it on read. Where ``indexed``, the
    sparse vector of a point is stored as the slots of the vocabulary entries that it has. An entry keeps its slot while
    its place and weight change, which are looked up on read: new documents change the weights of stored points
    without touching them. Where ``coded``, a narrow table holds the 8-bit codes of the quantised prefixes beside the points: new points
    are added to it, and it is made anew when they widen the value range.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = f"loomdex_{hashlib.md5(self.root.encode()).hexdigest()[:12]}"
        spark.sql(f"create database if not exists {self.database} location {_quoted(self.root)}")

    # names in the catalog
    def _slug(self, name: str) -> str:
        if not name or "/" in name or name.startswith("."):
            raise ValueError(f"bad collection name {name!r}")
        return f"{re.sub('[^a-z0-9]', '_', name.lower())}_{hashlib.md5(name.encode()).hexdigest()[:8]}"

    def _view(self, name: str) -> str:
        return f"{self.database}.{self._slug(name)}"

    def _state(self, name: str) -> dict:
        """Configuration and table names of the current build."""
        if not self.exists(name):
            raise CollectionMissing(name)
        return _decoded(self.spark.sql(f"show tblproperties {self._view(name)} ('{PROPERTY}')").first()["value"])

    def _publish(self, name: str, state: dict) -> None:
        """Make a build the current one: a single statement."""
        source = f"select * from {self.database}.{state['points']}" if state.get("points") else "select cast(null as string) as id where false"
        self.spark.sql(f"create or replace view {self._view(name)} tblproperties ('{PROPERTY}' = {_quoted(_encoded(state))}) as {source}")

    def _save(self, name: str, part: str, rows: DataFrame, *partitions: str) -> str:
        """Write a new table of a collection; returns its name."""
        table = f"{self._slug(name)}__{part}_{uuid.uuid4().hex[:12]}"
        rows.write.format("parquet").partitionBy(*partitions).saveAsTable(f"{self.database}.{table}")
        return table

    def _table(self, name: str | None) -> DataFrame | None:
        return self.spark.table(f"{self.database}.{name}") if name else None

    def _tables(self, name: str) -> builtins.list[str]:
        rows = self.spark.sql(f"show tables in {self.database} like '{self._slug(name)}__*'").collect()
        return [r["tableName"] for r in rows]

    def _sweep(self, name: str, before: dict) -> None:
        """Drop tables that neither the current build nor the one before names."""
        used = {t for s in (self._state(name), before) for p in ("points", "vocabulary", "statistics", "codes") for t in [s.get(p)]}
        used |= {t for s in (self._state(name), before) for p in ("bounds", "counted") for t in s.get(p, [])}
        for table in set(self._tables(name)) - used:
            self.spark.sql(f"drop table if exists {self.database}.{table}")

    def list(self) -> builtins.list[str]:
        views = self.spark.sql(f"show views in {self.database}").collect()
        found = []
        for row in views:
            if row["isTemporary"]:
                continue
            value = self.spark.sql(f"show tblproperties {self.database}.{row['viewName']} ('{PROPERTY}')").first()["value"]
            found.append(_decoded(value)["name"])
        return sorted(found)

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self._view(name))

    def create(
        self,
        name: str,
        dense_size: int = DENSE_SIZE,
        sparse_size: int = 256,
        prefixes: Sequence[int] = PREFIXES,
        quantised: Sequence[int] = QUANTISED,
        payload: T.StructType | None = None,
        bucket_chars: int = 2,
        exist_ok: bool = False,
        recreate: bool = False,
        indexed: bool = False,
        coded: bool = False,
    ) -> bool:
        """Create an empty collection. False if it is there and ``exist_ok`` allows that.

        Two bucket characters make 256 partitions; take fewer for small collections.
        """
        if self.exists(name):
            if recreate:
                self.delete(name)
            elif exist_ok:
                return False
            else:
                raise CollectionExists(name)
        payload = payload or payload_type()
        prefixes = sorted(prefixes)
        if prefixes and prefixes[-1] > dense_size:
            raise ValueError(f"prefixes {prefixes} are longer than the vectors, which have {dense_size} elements")
        config = {
            "dense_size": dense_size,
            "sparse_size": sparse_size,
            "prefixes": prefixes,
            "quantised": [n for n in quantised if n in prefixes],
            "metric": {"text_dense": "cosine", "text_sparse": "dot"},
            "payload": payload.jsonValue(),
            "bucket_chars": bucket_chars,
            "indexed": indexed,
            "coded": coded,
        }
        self._publish(name, {"name": name, "version": 0, "config": config})
        return True

    def delete(self, name: str) -> bool:
        """Drop a collection; False if there was none."""
        if not self.exists(name):
            return False
        self.spark.sql(f"drop view {self._view(name)}")
        for table in self._tables(name):
            self.spark.sql(f"drop table if exists {self.database}.{table}")
        return True

    def restore(self, name: str, state: dict) -> None:
        """Enter a build into a catalog that does not know it: ``state`` is what :meth:`state` gave."""
        tables = [state.get(p) for p in ("points", "vocabulary", "statistics", "codes")] + state.get("bounds", []) + state.get("counted", [])
        for table in filter(None, tables):
            if not self.spark.catalog.tableExists(f"{self.database}.{table}"):
                self.spark.sql(f"create table {self.database}.{table} using parquet location {_quoted(f'{self.root}/{table}')}")
                if table == state.get("points"):
                    self.spark.sql(f"msck repair table {self.database}.{table}")
        self._publish(name, state)

    def state(self, name: str) -> dict:
        """Configuration and tables of the current build, as plain values."""
        return self._state(name)

    def config(self, name: str) -> dict:
        return self._state(name)["config"]

    def version(self, name: str) -> int:
        """How often the collection's tables have been replaced."""
        return self._state(name)["version"]

    def _schema(self, config: dict) -> T.StructType:
        fields = [("id", T.StringType()), ("text_dense", T.BinaryType()), ("prefix_dense", T.BinaryType()), ("text_sparse", T.BinaryType())]
        fields += [("payload", T.StructType.fromJson(config["payload"])), ("id_bucket", T.StringType())]
        return T.StructType([T.StructField(n, t) for n, t in fields])

    def points(self, name: str) -> DataFrame:
        """The points with packed vectors; unused columns are never read."""
        state = self._state(name)
        stored = self._table(state.get("points"))
        if stored is None:
            return self.spark.createDataFrame([], self._schema(state["config"]))
        if not state["config"]["indexed"]:
            return stored
        return stored.withColumn("text_sparse", weighed("text_sparse", self.slots(name)))

    def slots(self, name: str) -> builtins.list[tuple[int, int, float]]:
        """Place, slot and weight of each vocabulary entry: as many rows as its cap."""
        return [tuple(r) for r in self._table(self._state(name)["vocabulary"]).select("idx", "slot", "idf").collect()]

    def read(self, name: str, with_vectors: bool = True, with_payload: bool = True) -> DataFrame:
        """Points with their named vectors (dense, one per prefix, sparse) and payload."""
        config, stored = self.config(name), self.points(name)
        rest = ["payload"] if with_payload else []
        if not with_vectors:
            return stored.select("id", *rest)
        plain = stored.select(
            "id",
            unpack_vector("text_dense").alias("text_dense"),
            unpack_vector("prefix_dense").alias("prefix_dense"),
            unpack_vector("text_sparse", "double").alias("text_sparse"),
            *rest,
        )
        prefixes = [vector_prefix("prefix_dense", n).alias(f"m{n}") for n in config["prefixes"]]
        return plain.select("id", "text_dense", *prefixes, "text_sparse", *rest)

    def vector_size(self, name: str, vector: str = "text_sparse") -> int | None:
        """Length of a stored vector, from one point."""
        width = 8 if vector == "text_sparse" else 4
        row = self.points(name).select(F.octet_length(vector).alias("n")).limit(1).first()
        return row["n"] // width if row else None

    def vocabulary(self, name: str) -> DataFrame | None:
        found = self._table(self._state(name).get("vocabulary"))
        return None if found is None else found.select("idx", "token", "n", "idf")

    def token_slots(self, name: str) -> dict[str, int]:
        """Slots of the tokens of the current vocabulary."""
        found = self._table(self._state(name).get("vocabulary"))
        return {} if found is None else {r["token"]: r["slot"] for r in found.select("token", "slot").collect() if r["slot"] >= 0}

    def statistics(self, name: str) -> DataFrame | None:
        """Token statistics of the documents that the collection has counted."""
        return self._table(self._state(name).get("statistics"))

    def counted(self, name: str) -> DataFrame:
        """Ids of the documents that the statistics cover."""
        parts = self._state(name).get("counted", [])
        if not parts:
            return self.spark.createDataFrame([], "id string")
        return self._union(parts)

    def _union(self, parts: Sequence[str]) -> DataFrame:
        out = self._table(parts[0])
        for part in parts[1:]:
            out = out.unionByName(self._table(part))
        return out

    def replace(
        self,
        name: str,
        vocabulary: DataFrame,
        statistics: DataFrame,
        counted: DataFrame,
        added: DataFrame,
        change: Callable[[DataFrame], DataFrame] | None = None,
    ) -> int:
        """The next build: new vocabulary and statistics, ``counted`` ids beside those before, and ``added`` points.

        With ``change`` stored points (id, text_dense, payload) are written anew through it, with those added. Without it they
        stay as they are, and the added ones join them just before the build is published: they are whole and may be
        found a moment earlier, by the weights before. Returns how many points were added.
        """
        before = self._state(name)
        state = {**before, "version": before["version"] + 1}
        state["vocabulary"] = self._save(name, "vocabulary", vocabulary.select("idx", "token", "n", "idf", "slot").coalesce(1))
        state["statistics"] = self._save(name, "statistics", statistics)
        state["counted"] = [*before.get("counted", []), self._save(name, "counted", counted.select("id"))]
        if len(state["counted"]) > COUNTED_TABLES:
            state["counted"] = [self._save(name, "counted", self._union(state["counted"]))]
        if change and before.get("points"):
            stored = self._table(before["points"]).select("id", unpack_vector("text_dense").alias("text_dense"), "payload")
            state |= {"points": None, "bounds": [], "codes": None}
            self._append(name, state, change(stored))
        n = self._append(name, state, added)
        self._publish(name, state)
        self._sweep(name, before)
        return n

    def bounds(self, name: str) -> dict[int, tuple[float, float]]:
        """Value range per quantised prefix over everything appended so far."""
        parts = self._state(name).get("bounds", [])
        return bounds_dict(self._union(parts)) if parts else {}

    def codes(self, name: str) -> DataFrame:
        """Stored 8-bit codes (id, codes) of the quantised prefixes, from short to long."""
        state = self._state(name)
        if not state["config"].get("coded"):
            raise ValueError(f"collection {name!r} keeps no codes")
        stored = self._table(state.get("codes"))
        return self.spark.createDataFrame([], "id string, codes binary") if stored is None else stored

    def code_bounds(self, name: str) -> dict[int, tuple[float, float]]:
        """Value ranges that the stored codes were made with."""
        return {int(n): (low, high) for n, (low, high) in self._state(name).get("code_bounds", {}).items()}

    def _encode(self, name: str, state: dict) -> None:
        """Bring the codes of a build up to its points: those not coded yet, or all if the value range is another."""
        bounds = bounds_dict(self._union(state["bounds"]))
        spans = {str(n): list(b) for n, b in sorted(bounds.items())}
        stored = self._table(state["points"])
        known = self._table(state["codes"]) if state.get("codes") and state.get("code_bounds") == spans else None
        if known is not None:
            stored = stored.join(known.select("id"), "id", "left_anti")
        rows = stored.select("id", code_column(unpack_vector("prefix_dense"), bounds).alias("codes"))
        if known is None:
            state |= {"codes": self._save(name, "codes", rows), "code_bounds": spans}
        else:
            rows.write.format("parquet").mode("append").saveAsTable(f"{self.database}.{state['codes']}")

    def with_ids(self, df: DataFrame, name: str, *keys: str, random: bool = False) -> DataFrame:
        """Add the point id: a digest of collection and keys, or a fresh random id."""
        parts = [F.lit(name), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]]
        fresh = F.uuid() if random else F.sha2(F.concat_ws("\x1f", *parts), 256)
        return df.withColumn("id", fresh)

    def without_known(self, df: DataFrame, name: str) -> DataFrame:
        """Rows whose id is not stored yet. Done before vectors exist, it moves narrow rows.

        The ids of ``df`` are written first. Stored ids are met with them by bucket and id in a semi-join, for which Spark reads
        the buckets that occur only and, for large tables, filters stored ids by a Bloom filter before it moves them. So what
        ``df`` meets has its own size at most, whatever is stored. ``df`` is evaluated once more for its ids.
        """
        state = self._state(name)
        stored = self._table(state.get("points"))
        if stored is None:
            return df
        bucket = F.substring("id", 1, state["config"]["bucket_chars"]).alias("id_bucket")
        asked = written(df.select("id", bucket), "asked-ids")
        asked = asked.where(F.col("id_bucket") >= "")  # not null; partitions are pruned by filtered tables only
        known = stored.select("id_bucket", "id").join(asked, ["id_bucket", "id"], "left_semi")
        return df.join(known.select("id"), "id", "left_anti")

    def upsert(self, name: str, points: DataFrame, skip_known: bool = True) -> int:
        """Append points (id, text_dense, text_sparse, payload); returns how many were written.

        With ``skip_known`` stored ids are left alone and of equal ids one is taken, so a repeated
        run adds nothing; without it the caller answers for that. Value ranges and the row count are
        observed while writing, not in passes of their own.
        """
        if skip_known:
            points = self.without_known(points, name).dropDuplicates(["id"])
        before = self._state(name)
        state = json.loads(json.dumps(before))
        n = self._append(name, state, points)
        if state != before:
            self._publish(name, state)
        return n

    def _append(self, name: str, state: dict, points: DataFrame) -> int:
        """Write points to the table that ``state`` names, or a new one, and note it there with their value range."""
        config = state["config"]
        longest = max(config["prefixes"], default=0)
        sparse = F.col("text_sparse").cast("array<int>" if config["indexed"] else "array<double>")
        rows = points.select(
            "id",
            F.col("text_dense").cast("array<float>").alias("text_dense"),
            vector_prefix("text_dense", longest).cast("array<float>").alias("prefix_dense"),
            sparse.alias("text_sparse"),
            "payload",
            F.substring("id", 1, config["bucket_chars"]).alias("id_bucket"),
        )
        seen = Observation()
        measures = [F.count(F.lit(1)).alias("n")]
        for n in config["quantised"]:
            unit = unit_prefix("prefix_dense", n)
            measures.append(F.min(F.array_min(unit)).cast("double").alias(f"low{n}"))
            measures.append(F.max(F.array_max(unit)).cast("double").alias(f"high{n}"))
        # rebalance evens out file sizes within the partitions; AQE picks the number of tasks
        packed = rows.observe(seen, *measures).select(
            "id",
            pack_vector("text_dense").alias("text_dense"),
            pack_vector("prefix_dense").alias("prefix_dense"),
            pack_vector("text_sparse", "int" if config["indexed"] else "double").alias("text_sparse"),
            "payload",
            "id_bucket",
        )
        # within a file ids are sorted, so its statistics tell which of its pages may hold an id
        sized = packed.hint("rebalance", "id_bucket").sortWithinPartitions("id_bucket", "id")
        if state.get("points"):
            table = f"{self.database}.{state['points']}"
            sized.write.format("parquet").partitionBy("id_bucket").mode("append").saveAsTable(table)
        else:
            state["points"] = self._save(name, "points", sized, "id_bucket")
        try:
            got = seen.get
        except Py4JJavaError:
            if not points.isEmpty():  # adaptive execution drops the measures of an empty result only
                raise
            got = {"n": 0}
        if got["n"] and config["quantised"]:
            spans = [(n, got[f"low{n}"], got[f"high{n}"]) for n in config["quantised"]]
            kept = self._union(state["bounds"]).groupBy("prefix").agg(F.min("low"), F.max("high")).collect() if state.get("bounds") else []
            rows = self.spark.createDataFrame([*spans, *map(tuple, kept)], BOUNDS_SCHEMA)  # a few rows
            state["bounds"] = [self._save(name, "bounds", rows.coalesce(1))]
            if config.get("coded"):
                self._encode(name, state)
        return got["n"]
