"""Exact dedup: a tree-merge of sorted digest runs, in DataFrame functions only.

Every row gets a digest of its normalised text and belongs to one of ``fan_in ** rounds``
runs. A run lies in one partition, sorted by digest, with one entry per digest: the
identifier that stays and the number of rows.

The runs are numbered by ``rounds`` digits to the base ``fan_in``. In round k the runs that
differ in digit k alone exchange their parts: each takes the entries whose digest has its own
digit there, sorts them in and merges equal digests. With ``fan_in`` 2 these are the rounds
of a binomial exchange; wider ones merge several runs at once. After the last round every
digest is in one run, as one entry. No run ever holds more than one entry per digest and
merged run, so a digest with a third of all rows weighs no more than any other.

The way back hands the winner down the same rounds: an entry's parent is the run that took
it, so no join meets more than ``fan_in`` entries of a digest.

Equality is verified at every level: entries merge only when the digest, a second
independent hash and the byte length all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

KEY = ["digest", "check", "n_bytes"]
#: Rows that a run of the first level holds at most, on average.
RUN_ROWS = 4_000_000


def runs_of(entries: DataFrame) -> DataFrame:
    """The entries of each run brought into one partition; a merge then sorts them there."""
    return entries.repartition("run")


def taking_run(k: int, fan_in: int) -> Column:
    """The run that takes an entry in round ``k``: its own, with the digest's digit k."""
    bits, at = fan_in.bit_length() - 1, fan_in ** k
    own = F.floor(F.col("run") / at) % fan_in
    return F.col("run") + (F.pmod(F.shiftright("check", bits * k), F.lit(fan_in)) - own) * at


def merge_round(entries: DataFrame, k: int, fan_in: int) -> DataFrame:
    """Runs after round ``k``: parts exchanged, sorted in and merged."""
    return (runs_of(entries.withColumn("run", taking_run(k, fan_in))).groupBy("run", *KEY)
            .agg(F.max("best").alias("best"), F.sum("n").alias("n")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                fan_in: int = 8, rounds: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z. ``keep`` ("largest" or
    "smallest") says which identifier of a group stays. Null texts count as empty; empty
    texts form one group; texts of any length are hashed whole. Rows repeated with the same
    identifier count separately and exactly one of them is ``kept``. A null identifier stays
    only where its group has no other. ``fan_in`` is a power of two; the number of rounds
    follows from the number of rows (two at least) unless given. Further columns are
    ignored; an empty table gives an empty result.
    """
    sign = 1 if keep == "largest" else -1
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = written(docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
                   .select("id", F.sha2("text", 256).alias("digest"), F.xxhash64("text").alias("check"),
                           F.octet_length("text").alias("n_bytes"), F.monotonically_increasing_id().alias("row")), "digests")
    if rounds is None:
        rounds, n = 2, rows.count()
        while fan_in ** rounds * RUN_ROWS < n:
            rounds += 1
    rows = rows.withColumn("run", F.pmod("row", F.lit(fan_in ** rounds)))
    entry = F.struct((F.col("id") * sign).alias("rank"), (-F.col("row")).alias("row"))
    levels = [runs_of(rows).groupBy("run", *KEY).agg(F.max(entry).alias("best"), F.count("*").alias("n"))]
    for k in range(rounds):
        levels[-1] = written(levels[-1], f"run-level-{k}")
        levels.append(merge_round(levels[-1], k, fan_in))
    won = levels.pop()
    for k in reversed(range(rounds)):
        won = (levels[k].select(*KEY, F.col("run").alias("sub"), taking_run(k, fan_in).alias("run"))
               .join(won, ["run", *KEY]).select(*KEY, F.col("sub").alias("run"), "best", "n"))
    return (rows.join(won, ["run", *KEY])
            .select(F.col("id").alias(id_col), (F.col("best.rank") * sign).alias("keep_id"),
                    F.col("n").alias("group_size"), (F.col("row") == -F.col("best.row")).alias("kept"),
                    F.col("digest").alias("text_sha256")))
