"""Reports as whole documents: one nested value per run, whose sections differ in shape (SNK3, SNK4).

A section is a table; in the document it is an array of objects, or one object if the section has a
single row by nature. The document is a VARIANT: sections keep their own fields and types, new ones
need no change of the stored schema, and a path reads one of them without parsing text.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_JSON = {"ignoreNullFields": "false"}


def _section(df: DataFrame, name: str, single: bool) -> DataFrame:
    """(run_id, name): the rows of each run as JSON text."""
    fields = [c for c in df.columns if c != "run_id"]
    row = F.struct(*[F.col(f"`{c}`") for c in fields])
    value = F.to_json(F.first(row), _JSON) if single else F.to_json(F.array_sort(F.collect_list(row)), _JSON)
    return df.groupBy("run_id").agg(value.alias(name))


def documents(report_type: str, sections: Mapping[str, DataFrame], single: Sequence[str] = ()) -> DataFrame:
    """(run_id, report_type, document) for every run that any section has rows of.

    Each section is a table with a ``run_id``; one of a run holds what its rules, tables and error
    types give, whatever the size of the data. Sections without rows of a run are empty arrays, or
    null where ``single`` names them.
    """
    parts = [_section(df, name, name in single) for name, df in sections.items()]
    joined = reduce(lambda a, b: a.join(b, "run_id", "full"), parts)
    texts = []
    for k, name in enumerate(sections):
        texts += [F.lit(f"{',' if k else '{'}{json.dumps(name)}:"),
                  F.coalesce(F.col(f"`{name}`"), F.lit("null" if name in single else "[]"))]
    return joined.select("run_id", F.lit(report_type).alias("report_type"),
                         F.parse_json(F.concat(*texts, F.lit("}"))).alias("document"))


def section(docs: DataFrame, name: str, ddl: str, single: bool = False) -> DataFrame:
    """The rows of one section, with the run they belong to; ``ddl`` names the fields that are wanted.
    A document without the section, or with an empty one, gives no row."""
    if single:
        value = F.variant_get("document", f"$['{name}']", f"struct<{ddl}>")
        return docs.select("run_id", value.alias("_s")).where("_s IS NOT NULL").select("run_id", "_s.*")
    value = F.variant_get("document", f"$['{name}']", f"array<struct<{ddl}>>")
    return docs.select("run_id", F.inline(value))


def document_shape(docs: DataFrame) -> DataFrame:
    """One row per type of document: the schema that covers all its documents."""
    return docs.groupBy("report_type").agg(F.schema_of_variant_agg("document").alias("shape"))
