"""Line dedup by a log-template tree, in DataFrame functions only.

A line is parsed to its tokens; tokens with a digit are variable fields at once. The tree
has fixed depth: lines with the same number of tokens and the same leading tokens share a
leaf. In a leaf that enough documents reach, a token that few of them have at its position
is a variable field too. A line most of which stays constant then has a template; lines that
differ from the leaf's main template in variable fields only take that one. A template that
enough documents hold recurs: its first line stays, its other lines are dropped. A line
with too little constant text, a row of numbers say, has no template and recurs only where
it is repeated as it is, as do short lines and long ones that few documents share.

Texts are joined by merging at every size, so that the plan does not change as tables grow.
Only hashes of lines are shuffled until the leaves are known. The lines of a leaf are
compared once each, whatever number of documents repeats them, and meet their leaf's
statistics by position and token, never each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, fresh, written

FIELD = "<*>"
_BLANK = r"[\x20\x09-\x0D]"


def line_tokens(line: Column) -> Column:
    return F.array_remove(F.split(line, f"{_BLANK}+"), "")


def masked(tokens: Column, line: Column) -> Column:
    """The tokens of ``line`` with those that hold a digit as fields."""
    return F.when(line.rlike("[0-9]"), F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), FIELD).otherwise(t))).otherwise(tokens)


def constant_enough(tokens: Column, constant: float) -> Column:
    return F.size(F.filter(tokens, lambda x: x != FIELD)) >= constant * F.size(tokens)


def _digests(prefix: str, joined: Column) -> list[Column]:
    return [F.xxhash64(joined).alias(prefix), F.xxhash64(F.lit(1), joined).alias(prefix + "2")]


def first_places(placed: DataFrame, key: list[str], place: list[str], *more: Column) -> DataFrame:
    """For each key the number of documents that hold it, and the first place of all. The
    hot key of a line that very many documents repeat is counted by document first."""
    at = F.struct(*place)
    return (placed.groupBy(*key, place[0]).agg(F.min(at).alias("at"), *more).groupBy(*key)
            .agg(F.count("*").alias("docs"), F.min("at").alias("first"), *more))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 3, min_tokens: int = 3,
                min_docs: int = 4, constant: float = 0.8, long_line: int = 40, min_copies: int = 2) -> DataFrame:
    """``docs`` with ``text_col`` cut, and the columns ``n_lines`` and ``n_dropped`` added.

    Lines end at newlines; what white space stands between their tokens makes no difference.
    Two rules drop lines, and each leaves the first of its lines by identifier and position:

    * a template that ``min_docs`` documents hold recurs. A line of at least ``min_tokens``
      tokens has a template if at least ``constant`` of its tokens are neither a field nor
      one that few documents have there; a table's rows of distinct numbers have none;
    * an identical line recurs in ``min_docs`` documents, whatever its tokens, and in
      ``min_copies`` if it has at least ``long_line`` characters.

    Blank lines stay. Null texts stay null, empty ones empty; rows repeated with the same
    identifier and text are one document and are cut alike. Rows without identifier count as
    one document. A text of very many lines takes time in proportion to them. An empty table
    gives an empty result. Other columns pass through, but for any named like the two added
    ones.
    """
    _doc, _row, _gone = fresh(docs, "_doc", "_row", "_gone")
    lines = F.split(F.col(text_col), "\n")
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias(_doc)
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias(_row)
    place = [_doc, _row, "pos"]
    parsed = (docs.select(doc, row, F.posexplode(lines).alias("pos", "line"))
              .select(*place, "line", line_tokens(F.col("line")).alias("t"))
              .select(*place, "t", masked(F.col("t"), F.col("line")).alias("m"))
              .select(*place, "t", "m", F.array_join("t", " ").alias("exact"), F.array_join("m", " ").alias("mask"))
              .select(*place, *_digests("exact", F.col("exact")), (F.length("exact") >= long_line).alias("long"), *_digests("line", F.col("mask")),
                      (F.size("t") > 0).alias("some"), F.when((F.size("t") >= min_tokens) & constant_enough(F.col("m"), constant),
                                                              F.xxhash64(F.size("t"), *[F.get("m", F.lit(k)) for k in range(depth)])).alias("leaf")))
    # blank lines go after the write: a filter on the tokens would have them parsed twice
    parsed = written(parsed, "lines").where("some")
    copies = first_places(parsed, ["exact", "exact2"], place, F.max("long").alias("long"))
    copies = written(copies.where((F.col("docs") >= min_docs) | F.col("long") & (F.col("docs") >= min_copies)), "copies")
    repeated = parsed.join(copies, ["exact", "exact2"]).where(F.struct(*place) != F.col("first")).select(*place)
    templated = parsed.where("leaf IS NOT NULL")
    leaves = written(templated.select("leaf", _doc).distinct().groupBy("leaf").agg(F.count("*").alias("docs"))
                     .where(F.col("docs") >= min_docs).select("leaf"), "leaves")
    key = ["leaf", "line", "line2"]
    shared = written(templated.select(*key, *place).join(leaves, "leaf"), "shared-lines")
    once = first_places(shared, key, place)
    wanted = once.groupBy(f"first.{_doc}", f"first.{_row}").agg(F.collect_list(F.struct("first.pos", *key, F.col("docs").alias("n"))).alias("of"))
    texts = docs.select(doc, row, F.col(text_col).alias("text"))
    distinct = written(texts.join(written(wanted, "wanted").hint("merge"), [_doc, _row])
                       .select(F.split("text", "\n").alias("lines"), F.explode("of").alias("x"))
                       .select("x.leaf", "x.line", "x.line2", "x.n", F.get("lines", F.col("x.pos")).alias("text"))
                       .select(*key, "n", "text", line_tokens(F.col("text")).alias("t")).select(*key, "n", masked(F.col("t"), F.col("text")).alias("t"))
                       .dropDuplicates(key), "distinct-lines")
    templates = written(generalised(distinct, min_docs, constant), "templates")
    placed = written(shared.join(templates, key).select("template", *place), "placed")
    recurring = written(first_places(placed, ["template"], place).where(F.col("docs") >= min_docs), "recurring")
    fitting = placed.join(recurring, "template").where(F.struct(*place) != F.col("first")).select(*place)
    gone = written(repeated.unionByName(fitting).groupBy(_doc, _row).agg(F.array_sort(F.collect_set("pos")).alias(_gone)), "gone")
    # lines between two dropped ones stay: flags line by line, in one walk over the sorted positions
    between = F.transform(_gone, lambda p, k: p - F.coalesce(F.get(_gone, k - 1), F.lit(-1)) - 1)
    stays = F.flatten(F.transform(between, lambda n: F.concat(F.array_repeat(F.lit(True), n), F.array(F.lit(False)))))
    kept = F.filter(F.zip_with(lines, stays, lambda x, k: F.struct(x.alias("x"), F.coalesce(k, F.lit(True)).alias("k"))), lambda s: s["k"])
    cut = F.when(F.col(_gone).isNull(), F.col(text_col)).otherwise(F.array_join(F.transform(kept, lambda s: s["x"]), "\n"))
    return (docs.select(*columns(docs), doc, row).join(gone.hint("merge"), [_doc, _row], "left")
            .select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")],
                    F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"), F.when(F.col(_gone).isNull(), 0).otherwise(F.size(_gone)).alias("n_dropped")))


def generalised(distinct: DataFrame, min_docs: int, constant: float) -> DataFrame:
    """(``leaf``, ``line``, ``line2``, ``template``) of those of the distinct lines ``leaf,
    line, line2, n, t`` with masked tokens ``t``, held by ``n`` documents, that have a
    template; the template as a digest."""
    tokens = distinct.select("leaf", "line", "line2", "n", F.posexplode("t").alias("p", "token"))
    frequent = written(tokens.groupBy("leaf", "p", "token").agg(F.sum("n").alias("s")).where(F.col("s") >= min_docs).drop("s"), "frequent")
    same = (F.col("x.leaf") == F.col("f.leaf")) & (F.col("x.p") == F.col("f.p")) & (F.col("x.token") == F.col("f.token"))
    general = (tokens.select("leaf", "line", "line2", "p", "token").alias("x").join(frequent.alias("f"), same, "left")
               .select("x.leaf", "x.line", "x.line2", F.struct("x.p", F.coalesce("f.token", F.lit(FIELD)).alias("token")).alias("part"))
               .groupBy("leaf", "line", "line2").agg(F.transform(F.array_sort(F.collect_list("part")), lambda s: s["token"]).alias("general")))
    signed = written(distinct.join(general, ["leaf", "line", "line2"]).where(constant_enough(F.col("general"), constant))
                     .select("leaf", "line", "line2", "n", F.col("general").alias("sign")), "signed")
    main = written(signed.groupBy("leaf", "sign").agg(F.sum("n").alias("s")).groupBy("leaf")
                   .agg(F.max_by("sign", F.struct("s", "sign")).alias("main")), "main")
    fits = F.forall(F.zip_with("sign", "main", lambda a, b: (a == b) | (a == FIELD) | (b == FIELD)), lambda ok: ok)
    template = F.when(fits, F.col("main")).otherwise(F.col("sign"))
    return signed.join(main, "leaf").select("leaf", "line", "line2", F.sha2(F.array_join(template, " "), 256).alias("template"))
