"""Archive table shape: projection, evolution, column mapping, full object validation."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.sources.contract import contract_violations


def exclude_errors(columns: list[str], exclude: str | None, key: str) -> list[tuple[str, str]]:
    """EX1 not JSON, EX2 not strings, EX3 key excluded, EX4 unknown column."""
    if exclude is None or not exclude.strip():
        return []
    try:
        items = json.loads(exclude)
    except ValueError:
        return [("EX1", exclude)]
    items = items if isinstance(items, list) else [items]
    known = {c.lower() for c in columns}
    out = [("EX2", str(i)) for i in items if not isinstance(i, str)]
    names = [i.strip() for i in items if isinstance(i, str)]
    out += [("EX3", n) for n in names if n.lower() == key.lower()]
    out += [("EX4", n) for n in names if n and n.lower() not in known]
    return out


def archive_projection(df: DataFrame, exclude: str | None, key: str) -> DataFrame:
    """Source columns in source order without the excluded ones; pruned at the scan."""
    errors = exclude_errors(df.columns, exclude, key)
    if errors:
        raise ValueError(f"exclude columns: {errors}")
    names = {n.strip().lower() for n in json.loads(exclude)} if exclude and exclude.strip() else set()
    return df.select(*[c for c in df.columns if c.lower() not in names])


def evolution_errors(source: DataFrame, archive: DataFrame | None, key: str, *, create: bool = True,
                     update: bool = True, ignore_missing: bool = False) -> list[tuple[str, str]]:
    """TA2 no table and no create, TA3 type mismatch, TA4 missing column, TA7 key missing."""
    src = {f.name.lower(): f.dataType for f in source.schema.fields}
    out = [] if key.lower() in src else [("TA7", key)]
    if archive is None:
        return out if create else out + [("TA2", "")]
    arc = {f.name.lower(): f.dataType for f in archive.schema.fields}
    out += [("TA3", n) for n, t in src.items() if n in arc and arc[n] != t]
    if not update and not ignore_missing:
        out += [("TA4", n) for n in src if n not in arc]
    return out


def evolve(archive: DataFrame, new_rows: DataFrame, key: str, *, update: bool = True,
           ignore_missing: bool = False) -> DataFrame:
    """Archive plus new rows; columns the archive lacks are NULL in its old rows."""
    errors = evolution_errors(new_rows, archive, key, update=update, ignore_missing=ignore_missing)
    if errors:
        raise ValueError(f"archive table: {errors}")
    if not update:
        keep = {c.lower() for c in archive.columns}
        new_rows = new_rows.select(*[c for c in new_rows.columns if c.lower() in keep])
    return archive.unionByName(new_rows, allowMissingColumns=True)


def parse_mapping(mapping: str) -> list[tuple[str, str, str]]:
    """``src=dst, ...`` as distinct ``(item, source, target)``; brackets around names are dropped."""
    def bare(name: str) -> str:
        name = name.strip()
        return name[1:-1] if name.startswith("[") and name.endswith("]") else name

    out = []
    for item in dict.fromkeys(i.strip() for i in mapping.split(",")):
        if item:
            source, _, target = item.partition("=") if "=" in item else ("", "", item)
            out.append((item, bare(source), bare(target)))
    return out


def mapping_errors(columns: list[str], mapping: str, key: str, copy_key: bool = False) -> list[tuple[str, str]]:
    """Five checks: missing source, duplicate target, mapped and removed, key mapped, unknown source."""
    items = parse_mapping(mapping)
    known = {c.lower() for c in columns}
    out = [("missing source", item) for item, source, _ in items if not source]
    targets = [t for _, _, t in items if t]
    out += [("duplicate target", t) for t in dict.fromkeys(targets) if targets.count(t) > 1]
    kept = {s for _, s, t in items if t}
    dropped = {s for _, s, t in items if not t}
    out += [("mapped and removed", item) for item, s, _ in items if s in kept & dropped]
    out += [("key mapped", item) for item, s, t in items if s.lower() == key.lower() and t and not copy_key]
    out += [("unknown source", s) for _, s, _ in items if s and s.lower() not in known]
    return out


def map_columns(df: DataFrame, mapping: str, key: str, copy_key: bool = False) -> DataFrame:
    """Renamed columns; an empty target drops the column, the key goes only with permission."""
    errors = mapping_errors(df.columns, mapping, key, copy_key)
    if errors:
        raise ValueError(f"column mapping: {errors}")
    targets = {s.lower(): t for _, s, t in parse_mapping(mapping)}
    cols = []
    for name in df.columns:
        target = targets.get(name.lower(), name)
        if target and (copy_key or name.lower() != key.lower()):
            cols.append(F.col(name).alias(target))
    return df.select(*cols)


def archive_range(source: DataFrame, time: str, before, keep_before=None) -> DataFrame:
    """Rows before a date and, when given, not before another: the range copy without delete."""
    rows = source.where(F.col(time) < F.expr(f"timestamp_ntz'{before}'"))
    return rows if keep_before is None else rows.where(F.col(time) >= F.expr(f"timestamp_ntz'{keep_before}'"))


def validate_objects(source: DataFrame, archive: DataFrame | None, status: DataFrame, expected: DataFrame,
                     status_expected: DataFrame, exclude: str | None, key: str) -> DataFrame:
    """All checks of one archived table in one report ``(object, code, detail)``."""
    spark = source.sparkSession
    from ebbline.sources.contract import schema_rows

    def checked(df, contract, label):
        table = contract.select("table_name").first()[0]
        return contract_violations(schema_rows(spark, table, df), contract).select(
            F.lit(label).alias("object"), "code", F.coalesce("name", "table_name").alias("detail"))

    rows = [("archive", c, d) for c, d in exclude_errors(source.columns, exclude, key)]
    rows += [("archive", c, d) for c, d in evolution_errors(source, archive, key)]
    extra = spark.createDataFrame(rows, "object string, code string, detail string")
    return checked(source, expected, "source").unionByName(checked(status, status_expected, "status")).unionByName(extra)
