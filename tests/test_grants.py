from fleetwarden.operators import grants
from fleetwarden.sources.catalog import Snapshot


def snap(spark):
    ns = spark.createDataFrame([
        (1, 1, "app", ["x=UC/gr", "=U/gr", "y=C*/other", "z=X/gr"]), (1, 2, "pgx", ["x=U/gr"]),
        (1, 3, "pg", None), (1, 4, "information_schema", ["x=U/gr"])],
        "db_id long, oid long, nspname string, nspacl array<string>")
    cls = spark.createDataFrame([
        (1, 1, "My Table", "r", ["=r/gr", "a=arwdDxt/gr", "b=r*w/gr", "c=r", "d=r/other"]),
        (1, 1, "seq", "S", ["a=U/gr", "a=r/gr"]), (1, 1, "v1", "v", ["a=r/gr"]), (1, 1, "mv", "m", ["a=r/gr"]),
        (1, 1, "nul", "r", None), (1, 2, "hidden", "r", ["a=r/gr"])],
        "db_id long, relnamespace long, relname string, relkind string, relacl array<string>")
    proc = spark.createDataFrame([(1, 1, 1, "f", "integer, text", ["=X/gr", "a=X*/gr", "b=r/gr"])],
                                 "db_id long, oid long, pronamespace long, proname string, identity_args string, "
                                 "proacl array<string>")
    dacl = spark.createDataFrame([(1, "gr", "app", "r", ["x=ar/someone", "y=/gr"]), (1, "other", "app", "r", ["x=r/x"])],
                                 "db_id long, role string, nspname string, objtype string, defaclacl array<string>")
    return Snapshot(pg_class=cls, pg_namespace=ns, pg_proc=proc, pg_default_acl=dacl)


def test_relation_grants(spark):
    rows = sorted(r.grant_sql for r in grants.relation_grants(snap(spark), "gr", "Reader").collect())
    assert rows == sorted([
        'GRANT SELECT ON TABLE app."My Table" TO "Reader";',
        'GRANT INSERT, SELECT, UPDATE, DELETE, TRUNCATE, REFERENCES, TRIGGER ON TABLE app."My Table" TO "Reader";',
        'GRANT SELECT, UPDATE ON TABLE app."My Table" TO "Reader";',
        'GRANT  ON SEQUENCE app.seq TO "Reader";',
        'GRANT SELECT ON SEQUENCE app.seq TO "Reader";',
        'GRANT SELECT ON VIEW app.v1 TO "Reader";'])
    pub = [r for r in grants.relation_grants(snap(spark), "gr", "reader").collect() if r.acl_grantee == "PUBLIC"]
    assert len(pub) == 1
    corrected = grants.relation_grants(snap(spark), "gr", "reader", mode="corrected").collect()
    assert len(corrected) == 5 and all(r.valid for r in corrected)


def test_function_schema_default(spark):
    f = [r.grant_sql for r in grants.function_grants(snap(spark), "gr", "reader").collect()]
    assert f == ["GRANT EXECUTE ON FUNCTION app.f(integer, text) TO reader;"] * 2
    s = sorted(r.grant_sql for r in grants.schema_grants(snap(spark), "gr", "reader").collect())
    assert s == ["GRANT  ON SCHEMA app TO reader;", "GRANT USAGE ON SCHEMA app TO reader;",
                 "GRANT USAGE, CREATE ON SCHEMA app TO reader;"]
    d = sorted(r.grant_sql for r in grants.default_grants(snap(spark), "gr", "reader").collect())
    assert d == ["ALTER DEFAULT PRIVILEGES FOR ROLE gr IN SCHEMA app GRANT  ON rS TO reader;",
                 "ALTER DEFAULT PRIVILEGES FOR ROLE gr IN SCHEMA app GRANT INSERT, SELECT ON rS TO reader;"]
    dc = [r.grant_sql for r in grants.default_grants(snap(spark), "gr", "reader", mode="corrected").collect()]
    assert dc == ["ALTER DEFAULT PRIVILEGES FOR ROLE gr IN SCHEMA app GRANT INSERT, SELECT ON TABLES TO reader;"]
    rep = grants.grant_report(snap(spark), "gr", "reader")
    assert rep.count() == 6 + 2 + 3 + 2
    assert grants.grant_report(snap(spark), "gr", "reader", distinct=True).count() == 6 + 1 + 3 + 2


def test_grant_statements_view(spark):
    from fleetwarden.plans.views import register_views
    assert register_views(spark, acl=snap(spark), grantor="gr", grantee="reader") == ["grant_statements"]
    n = spark.sql("SELECT count(*) AS n FROM grant_statements WHERE source = 'schema' AND NOT valid").first().n
    assert n == 1
