from pyspark.sql import functions as F

from fleetwarden.functions.pgtext import pg_size_pretty, quote_ident, quote_literal


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_size_pretty(spark):
    cases = {0: "0 bytes", 10239: "10239 bytes", 10240: "10 kB", 4915200: "4800 kB",
             10485247: "10239 kB", 10485248: "10 MB", 10 * 1024 ** 3: "10 GB", -10240: "-10 kB",
             30 * 1024 ** 5: "30 PB"}
    for v, want in cases.items():
        assert _one(spark, pg_size_pretty(F.lit(v).cast("long"))) == want, v
    assert _one(spark, pg_size_pretty(F.lit(None).cast("long"))) is None


def test_quote_ident(spark):
    cases = {"abc": "abc", "My Table": '"My Table"', "select": '"select"', 'a"b': '"a""b"', "": '""',
             "pgx_app": "pgx_app", "1-urgent": '"1-urgent"', "a$b": '"a$b"', "user": '"user"'}
    for v, want in cases.items():
        assert _one(spark, quote_ident(F.lit(v))) == want, v


def test_quote_literal(spark):
    assert _one(spark, quote_literal(F.lit("O'Brien"))) == "'O''Brien'"
    assert _one(spark, quote_literal(F.lit("a\\b"))) == "E'a\\\\b'"
    assert _one(spark, quote_literal(F.lit(None).cast("string"))) == "NULL"


def _tdiv(a: int, b: int) -> int:
    """Integer division truncating toward zero (C semantics)."""
    q = abs(a) // b
    return q if a >= 0 else -q


def _pg_size_pretty_reference(size: int) -> str:
    """The PostgreSQL unit loop written out in Python, for the property test."""
    units = [("bytes", 10 * 1024, False, 0), ("kB", 20 * 1024 - 1, True, 10), ("MB", 20 * 1024 - 1, True, 20),
             ("GB", 20 * 1024 - 1, True, 30), ("TB", 20 * 1024 - 1, True, 40), ("PB", 20 * 1024 - 1, True, 50)]
    for i, (name, limit, rnd, bits) in enumerate(units):
        if i == len(units) - 1 or abs(size) < limit:
            if rnd:
                size = _tdiv(size + (1 if size >= 0 else -1), 2)
            return f"{size} {name}"
        nxt = units[i + 1]
        shift = nxt[3] - bits - (1 if nxt[2] else 0) + (1 if rnd else 0)
        size = _tdiv(size, 1 << shift)


def test_size_pretty_matches_unit_loop(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    vals = [0, 1, 10239, 10240, 20479 * 512 - 1, 20479 * 512, 2 ** 40, 2 ** 50 * 7, -5, -10240, -(2 ** 45)]

    @settings(max_examples=40, deadline=None)
    @given(st.integers(min_value=-(2 ** 60), max_value=2 ** 60))
    def collect(v):
        vals.append(v)
    collect()
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    for r in df.select("v", pg_size_pretty("v").alias("p")).collect():
        assert r.p == _pg_size_pretty_reference(r.v), r.v


def test_named_and_expression_paths_agree(spark):
    from fleetwarden.functions.pgtext import quote_ident_text
    names = ["abc", "My Table", "select", 'a"b', "", "1-urgent", "user", "x_1", "Café", "a`b"]
    df = spark.createDataFrame([(n, v) for n, v in zip(names, [0, 10239, 10240, 4915200, -10240, 2 ** 45, None,
                                                               10485248, 7, 1])], "n string, v long")
    rows = df.select(quote_ident("n").alias("a"), quote_ident(F.col("n")).alias("b"), "n",
                     pg_size_pretty("v").alias("c"), pg_size_pretty(F.col("v")).alias("d")).collect()
    for r in rows:
        assert r.a == r.b == quote_ident_text(r.n) and r.c == r.d
