"""Grant derivation (W30-W34): explode the ACL arrays of relations, functions, schemas
and default privileges, decode the letters and print grant statements for a target role.

``mode='reference'`` prints every entry of the expected grantor as the hub does (an entry
whose letters map to nothing gives an empty privilege list, and default grants print the
raw object-type letter followed by ``S``); ``valid`` flags such statements.
``mode='corrected'`` drops them and prints the proper plural object words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwarden.functions.acl import (DEFAULT_OBJTYPES, DEFAULT_PRIVILEGES, FUNCTION_PRIVILEGES,
                                       RELATION_KINDS, RELATION_PRIVILEGES, SCHEMA_PRIVILEGES, kind_word,
                                       parse_entry, privilege_list)
from fleetwarden.functions.pgtext import quote_ident, quote_ident_text
from fleetwarden.sources.catalog import Snapshot

MODES = ("reference", "corrected")
OUT_COLS = ["db_id", "source", "object_name", "acl_grantee", "privileges", "grant_sql", "valid"]


def _user_schema(nspname: Column) -> Column:
    """Outside the system schemas: not ``pg_%`` (any character after ``pg``) and not
    information_schema."""
    return ~nspname.like("pg_%") & (nspname != "information_schema")


def _explode_acl(df: DataFrame, acl_col: str) -> DataFrame:
    """One row per ACL entry, parsed; entries without a ``/grantor`` part are skipped.
    NULL arrays produce no rows."""
    e = df.filter(F.col(acl_col).isNotNull()).withColumn("_entry", F.explode(acl_col))
    parts = parse_entry(F.col("_entry"))
    return e.withColumns(parts).filter(F.col("usable"))


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")


def _finish(df: DataFrame, mode: str) -> DataFrame:
    out = df.select(*OUT_COLS)
    return out.filter(F.col("valid")) if mode == "corrected" else out


def relation_grants(snap: Snapshot, grantor: str, grantee: str, mode: str = "reference") -> DataFrame:
    """Tables, sequences and views (kinds r, S, v; other kinds skipped)."""
    _check_mode(mode)
    cls, nsp = snap.need("pg_class", "pg_namespace")
    n = nsp.filter(_user_schema(F.col("nspname"))).select("db_id", F.col("oid").alias("relnamespace"), "nspname")
    rel = cls.select("db_id", "relnamespace", "relname", "relkind", "relacl").join(n, ["db_id", "relnamespace"])
    e = _explode_acl(rel, "relacl").filter(F.col("acl_grantor") == grantor)
    e = e.withColumn("_kind", kind_word(F.col("relkind"), RELATION_KINDS)).filter(F.col("_kind").isNotNull())
    privs = privilege_list(F.col("letters"), RELATION_PRIVILEGES)
    obj = F.concat(quote_ident("nspname"), F.lit("."), quote_ident("relname"))
    return _finish(e.select(
        "db_id", F.lit("relation").alias("source"), obj.alias("object_name"), "acl_grantee",
        privs.alias("privileges"),
        F.concat(F.lit("GRANT "), privs, F.lit(" ON "), F.col("_kind"), F.lit(" "), obj, F.lit(" TO "),
                 F.lit(quote_ident_text(grantee)), F.lit(";")).alias("grant_sql"),
        (privs != "").alias("valid")), mode)


def function_grants(snap: Snapshot, grantor: str, grantee: str, mode: str = "reference") -> DataFrame:
    """EXECUTE on functions whose entry carries ``X``, with the identity arguments."""
    _check_mode(mode)
    proc, nsp = snap.need("pg_proc", "pg_namespace")
    n = nsp.filter(_user_schema(F.col("nspname"))).select("db_id", F.col("oid").alias("pronamespace"), "nspname")
    p = proc.select("db_id", "pronamespace", "proname", "identity_args", "proacl").join(n, ["db_id", "pronamespace"])
    e = _explode_acl(p, "proacl").filter((F.col("acl_grantor") == grantor) & F.col("letters").contains("X"))
    obj = F.concat(quote_ident("nspname"), F.lit("."), quote_ident("proname"), F.lit("("),
                   F.coalesce(F.col("identity_args"), F.lit("")), F.lit(")"))
    privs = privilege_list(F.col("letters"), FUNCTION_PRIVILEGES)
    return _finish(e.select(
        "db_id", F.lit("function").alias("source"), obj.alias("object_name"), "acl_grantee",
        privs.alias("privileges"),
        F.concat(F.lit("GRANT EXECUTE ON FUNCTION "), obj, F.lit(" TO "), F.lit(quote_ident_text(grantee)),
                 F.lit(";")).alias("grant_sql"),
        F.lit(True).alias("valid")), mode)


def schema_grants(snap: Snapshot, grantor: str, grantee: str, mode: str = "reference") -> DataFrame:
    """USAGE / CREATE on schemas."""
    _check_mode(mode)
    (nsp,) = snap.need("pg_namespace")
    n = nsp.filter(_user_schema(F.col("nspname"))).select("db_id", "nspname", "nspacl")
    e = _explode_acl(n, "nspacl").filter(F.col("acl_grantor") == grantor)
    privs = privilege_list(F.col("letters"), SCHEMA_PRIVILEGES)
    obj = quote_ident("nspname")
    return _finish(e.select(
        "db_id", F.lit("schema").alias("source"), obj.alias("object_name"), "acl_grantee",
        privs.alias("privileges"),
        F.concat(F.lit("GRANT "), privs, F.lit(" ON SCHEMA "), obj, F.lit(" TO "), F.lit(quote_ident_text(grantee)),
                 F.lit(";")).alias("grant_sql"),
        (privs != "").alias("valid")), mode)


def default_grants(snap: Snapshot, grantor: str, grantee: str, mode: str = "reference") -> DataFrame:
    """Default privileges of role ``grantor`` (selected by the owning role, not by the
    entry's grantor), all ten letters."""
    _check_mode(mode)
    (dacl,) = snap.need("pg_default_acl")
    d = dacl.filter(F.col("role") == grantor).select("db_id", "nspname", "objtype", "defaclacl")
    e = _explode_acl(d, "defaclacl")
    privs = privilege_list(F.col("letters"), DEFAULT_PRIVILEGES)
    plural = kind_word(F.col("objtype"), DEFAULT_OBJTYPES)
    if mode == "reference":
        objword = F.concat(F.col("objtype"), F.lit("S"))
        valid = (privs != "") & F.coalesce(objword == plural, F.lit(False))
    else:
        objword = plural
        valid = (privs != "") & plural.isNotNull()
    return _finish(e.select(
        "db_id", F.lit("default").alias("source"), quote_ident("nspname").alias("object_name"), "acl_grantee",
        privs.alias("privileges"),
        F.concat(F.lit("ALTER DEFAULT PRIVILEGES FOR ROLE "), F.lit(quote_ident_text(grantor)), F.lit(" IN SCHEMA "),
                 quote_ident("nspname"), F.lit(" GRANT "), privs, F.lit(" ON "), objword, F.lit(" TO "),
                 F.lit(quote_ident_text(grantee)), F.lit(";")).alias("grant_sql"),
        valid.alias("valid")), mode)


def grant_report(snap: Snapshot, grantor: str, grantee: str, mode: str = "reference",
                 distinct: bool = False) -> DataFrame:
    """The four sources in one list (UNION ALL; duplicates kept). With ``distinct``,
    identical statements collapse to one row carrying the smallest entry grantee."""
    parts = [relation_grants(snap, grantor, grantee, mode), function_grants(snap, grantor, grantee, mode),
             schema_grants(snap, grantor, grantee, mode), default_grants(snap, grantor, grantee, mode)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if not distinct:
        return out
    keys = [c for c in OUT_COLS if c != "acl_grantee"]
    return out.groupBy(*keys).agg(F.min("acl_grantee").alias("acl_grantee")).select(*OUT_COLS)
