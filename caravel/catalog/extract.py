"""Extraction of tables from catalog DataFrames: one plan of joins and aggregations for all tables, none a table.

A ``Catalog`` holds the catalog's relations under plain column names: relations, relation_fields, fields,
relation_constraints, ref_constraints, indices, index_segments, triggers, procedures, procedure_parameters.  They come
from JDBC or from any other DataFrame; catalogs are small, so the joined result is collected once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import types as ct
from .model import Column, Domain, ForeignKey, Index, Table, UniqueKey

IMPLICIT = "RDB$"
RELATIONS = ["relations", "relation_fields", "fields", "relation_constraints", "ref_constraints", "indices", "index_segments", "triggers", "procedures", "procedure_parameters"]


def trimmed(df: DataFrame) -> DataFrame:
    """Names without the catalog's blank padding."""
    return df.select(*[F.trim(c).alias(c.lower()) if t == "string" and not c.lower().endswith("source") or c.lower() == "field_source" else F.col(c).alias(c.lower()) for c, t in df.dtypes])


def without_default(text: str | None) -> str | None:
    """A default's SQL text without the word DEFAULT or its ``=``."""
    return re.sub(r"(?is)^\s*(?:default\b|=)\s*", "", text).strip() or None if text else None


SEQUENCE_CALL = r"(?is)\bnew\s*\.\s*\"?([A-Za-z_$][\w$]*)\"?\s*=\s*(?:gen_id\s*\(\s*\"?([A-Za-z_$][\w$]*)\"?\s*,|next\s+value\s+for\s+\"?([A-Za-z_$][\w$]*))"


@dataclass
class Catalog:
    frames: dict[str, DataFrame]

    @classmethod
    def of(cls, frames: dict[str, DataFrame]) -> Catalog:
        return cls({k: trimmed(v) for k, v in frames.items()})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, options: dict[str, str], queries: dict[str, str]) -> Catalog:
        """A catalog read by one query a relation."""
        return cls.of({name: spark.read.format("jdbc").options(**options).option("query", q).load() for name, q in queries.items()})

    def __getitem__(self, name: str) -> DataFrame:
        return self.frames[name]

    # scans
    def user_tables(self) -> DataFrame:
        return self["relations"].where("coalesce(system_flag, 0) = 0 AND view_blr IS NULL").select("relation_name")

    def relation_names(self) -> DataFrame:
        return self["relations"].select("relation_name").distinct()

    def columns(self) -> DataFrame:
        """Columns of all relations joined with their fields; a column's own null flag and default go before its domain's."""
        rf, f = self["relation_fields"].alias("rf"), self["fields"].alias("f")
        implicit = F.col("rf.field_source").startswith(IMPLICIT)
        return rf.join(f, F.col("rf.field_source") == F.col("f.field_name")).select(
            "rf.relation_name",
            F.col("rf.field_name").alias("column"),
            F.col("rf.field_position").alias("position"),
            "f.field_type", "f.field_sub_type", "f.field_length", "f.field_precision", "f.field_scale",
            F.coalesce("rf.null_flag", "f.null_flag").isNull().alias("nullable"),
            F.when(implicit, F.coalesce("rf.default_source", "f.default_source")).otherwise(F.col("rf.default_source")).alias("default"),
            F.when(~implicit, F.col("rf.field_source")).alias("domain"),
        )

    def unique_keys(self) -> DataFrame:
        """(relation_name, name, primary, columns) with a key's columns in segment order."""
        c = self["relation_constraints"].where(F.trim("constraint_type").isin("PRIMARY KEY", "UNIQUE")).withColumn("constraint_type", F.trim("constraint_type"))
        segments = F.transform(F.array_sort(F.collect_list(F.struct("field_position", "field_name"))), lambda x: x["field_name"])
        return c.join(self["index_segments"], "index_name").groupBy("relation_name", F.col("constraint_name").alias("name"), (F.col("constraint_type") == "PRIMARY KEY").alias("primary")).agg(segments.alias("columns"))

    def foreign_keys(self) -> DataFrame:
        """(relation_name, name, referenced, pairs): local and referenced segments of equal position, in order."""
        rc, con, seg = self["ref_constraints"], self["relation_constraints"], self["index_segments"]
        local = con.select("constraint_name", "relation_name", F.col("index_name").alias("l_index"))
        other = con.select(F.col("constraint_name").alias("const_name_uq"), F.col("relation_name").alias("referenced"), F.col("index_name").alias("r_index"))
        ls = seg.select(F.col("index_name").alias("l_index"), F.col("field_name").alias("local"), F.col("field_position").alias("pos"))
        rs = seg.select(F.col("index_name").alias("r_index"), F.col("field_name").alias("ref"), F.col("field_position").alias("pos"))
        joined = rc.join(local, "constraint_name").join(other, "const_name_uq").join(ls, "l_index").join(rs, ["r_index", "pos"])
        return joined.groupBy("relation_name", F.col("constraint_name").alias("name"), "referenced").agg(F.array_sort(F.collect_list(F.struct("pos", "local", "ref"))).alias("pairs"))

    def secondary_indexes(self) -> DataFrame:
        """(relation_name, name, unique, active, columns) of indexes that back no primary or unique key."""
        keys = self["relation_constraints"].where(F.trim("constraint_type").isin("PRIMARY KEY", "UNIQUE") & F.col("index_name").isNotNull()).select("index_name")
        segments = F.transform(F.array_sort(F.collect_list(F.struct("field_position", "field_name"))), lambda x: x["field_name"])
        i = self["indices"].join(keys, "index_name", "left_anti").join(self["index_segments"], "index_name")
        return i.groupBy("relation_name", F.col("index_name").alias("name"), (F.coalesce("unique_flag", F.lit(0)) == 1).alias("unique"), (F.coalesce("index_inactive", F.lit(0)) == 0).alias("active")).agg(segments.alias("columns"))

    def sequence_bindings(self) -> DataFrame:
        """(relation_name, column, sequence) from triggers that assign a sequence to a NEW column; comments do not count."""
        source = F.regexp_replace(F.regexp_replace("trigger_source", r"(?s)/\*.*?\*/", " "), r"--[^\n]*", " ")
        t = self["triggers"].where("coalesce(system_flag, 0) = 0").select("relation_name", source.alias("s"))
        g = lambda i: F.regexp_extract_all("s", F.lit(SEQUENCE_CALL), i)
        each = t.select("relation_name", F.explode(F.arrays_zip(g(1).alias("a"), g(2).alias("b"), g(3).alias("c"))).alias("x"))
        return each.select("relation_name", F.col("x.a").alias("column"), F.when(F.col("x.b") != "", F.col("x.b")).otherwise(F.col("x.c")).alias("sequence")).distinct()

    def triggers(self) -> DataFrame:
        return self["triggers"].where("coalesce(system_flag, 0) = 0").select(F.coalesce("trigger_name", F.lit("UNKNOWN")).alias("name"), "relation_name", "trigger_type", "trigger_source").orderBy("relation_name", "name")

    def procedures(self) -> DataFrame:
        """(name, source, ins, outs): parameters in order, as structs with their catalog types."""
        p = self["procedure_parameters"].join(self["fields"].withColumnRenamed("field_name", "field_source"), "field_source")
        item = F.struct("parameter_number", F.col("parameter_name").alias("name"), "field_type", "field_sub_type", "field_length", "field_precision", "field_scale")
        one = lambda kind: F.array_sort(F.collect_list(F.when(F.col("parameter_type") == kind, item)))
        params = p.groupBy("procedure_name").agg(one(0).alias("ins"), one(1).alias("outs"))
        return self["procedures"].where("coalesce(system_flag, 0) = 0").join(params, "procedure_name", "left").select(F.coalesce("procedure_name", F.lit("UNKNOWN")).alias("name"), F.col("procedure_source").alias("source"), "ins", "outs").orderBy("name")

    def views(self) -> DataFrame:
        """(name, source, columns) of views, columns in order."""
        cols = self["relation_fields"].groupBy("relation_name").agg(F.transform(F.array_sort(F.collect_list(F.struct("field_position", "field_name"))), lambda x: x["field_name"]).alias("columns"))
        return self["relations"].where("view_blr IS NOT NULL AND coalesce(system_flag, 0) = 0").join(cols, "relation_name", "left").select(F.col("relation_name").alias("name"), F.col("view_source").alias("source"), "columns").orderBy("name")

    def domains(self) -> DataFrame:
        return self["fields"].where("coalesce(system_flag, 0) = 0").where(~F.col("field_name").startswith(IMPLICIT)).orderBy("field_name")

    # records
    def tables(self) -> list[Table]:
        """All user tables, in order of name, from four aggregated plans."""
        names = [r[0] for r in self.user_tables().orderBy("relation_name").collect()]
        relations = [r[0] for r in self.relation_names().collect()]
        bound = {(r["relation_name"], r["column"].upper()): r["sequence"].lower() for r in self.sequence_bindings().collect()}
        columns: dict[str, list[Column]] = {}
        for r in self.columns().orderBy("relation_name", "position").collect():
            declared = ct.source_type(r["field_type"], r["field_sub_type"], r["field_length"], r["field_precision"], r["field_scale"])
            if declared is None and r["relation_name"] in names:
                raise ct.UnsupportedTypeError(f"{r['relation_name']}.{r['column']}: unknown type code {r['field_type']}")
            domain = ct.domain_name(r["domain"], relations) if r["domain"] else None
            columns.setdefault(r["relation_name"], []).append(Column(r["column"], declared or "", r["nullable"], without_default(r["default"]), bound.get((r["relation_name"], r["column"].upper())), domain))
        group = lambda rows, make: {k: [make(x) for x in rows if x["relation_name"] == k] for k in {x["relation_name"] for x in rows}}
        keys = group(self.unique_keys().orderBy("name").collect(), lambda r: UniqueKey(r["name"], tuple(r["columns"]), r["primary"]))
        refs = group(self.foreign_keys().orderBy("name").collect(), lambda r: ForeignKey(r["name"], tuple(p["local"] for p in r["pairs"]), r["referenced"], tuple(p["ref"] for p in r["pairs"])))
        idx = group(self.secondary_indexes().orderBy("name").collect(), lambda r: Index(r["name"], tuple(r["columns"]), r["unique"], r["active"]))
        return [Table(n, *(tuple(x.get(n, ())) for x in (columns, keys, refs, idx))) for n in names]

    def domain_records(self) -> list[Domain]:
        relations = [r[0] for r in self.relation_names().collect()]
        return [
            Domain(ct.domain_name(r["field_name"], relations), ct.source_type(r["field_type"], r["field_sub_type"], r["field_length"], r["field_precision"], r["field_scale"]) or "VARCHAR(255)", r["null_flag"] is None, without_default(r["default_source"]), r["validation_source"])
            for r in self.domains().collect()
        ]
