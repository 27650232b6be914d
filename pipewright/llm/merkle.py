r"""Merkle manifest of a dataset: leaves, subroots, a root, a proof for each row.

Every row is a leaf: the digest of its columns, each with its length.  Within a
group the leaves ascend by id, and every ``FANOUT`` consecutive nodes become the
digest of their concatenated digests until one, the group's subroot, is left;
the subroots, in the groups' order, likewise give the root.

Slot pivot.  A level is one aggregation: a node knows its place in its group, so
its parent is the place divided by the fanout and its slot the remainder;
conditional aggregates spread a parent's children into one column a slot, and
concatenating the columns hashes it.  Going down again, a parent's row makes its
children's rows: the columns without a child's own are its siblings, put before
what the parent has.  So proofs need one join a level, of the parents alone, and
the leaves (an eighth of them, with their path shared) are never joined at all.

Places.  Leaves are dealt by range of (group, id, leaf), sorted, and numbered
within their part; the parts' counts, a row a part and group, give each part's
start.  So no group, however large, is numbered by one task.

A proof is the list of (left, right) siblings from the leaf to the root.  Folding
a leaf through it gives a root; one that differs from the manifest's shows that
the leaf's row was changed.

Defined results: a null column is ``-`` in its leaf; a null group comes first;
a null id comes first in its group, and such a row counts as untampered; rows of
one id ascend by their leaf, and equal rows are interchangeable; a null or empty
text is a leaf like any other; an empty table gives an empty table; other
columns are never looked at.

Scale: one exchange by range of narrow rows, one exchange a level, each an eighth
of the one before.  Every level is a stored table, so a lost executor rereads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, stored, table

FANOUT = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the value's length in bytes, a colon, and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: list[Column]) -> Column:
    return digest(*[framed(c) for c in columns])


def group_key(group: Column) -> Column:
    """A key that is never null and keeps the groups' order, null first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with g's places (i, from 0) and size (n); ``rows`` must be a stored table.

    Sorted by g and ``order``.  Rows equal in all of it are dealt by the place
    they are stored at, so they don't meet in one task either.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("_at", F.monotonically_increasing_id()) \
        .repartitionByRange(parts, "g", *order, "_at").sortWithinPartitions("g", *order, "_at") \
        .withColumn("_at", F.monotonically_increasing_id())
    dealt = stored(dealt.withColumn("_part", F.shiftright("_at", 33)), "numbered")
    runs = dealt.groupBy("_part", "g").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # a row a part and group: the running count crosses all parts of a group, never its rows
    runs = runs.select(
        "_part", "g", "_first",
        F.expr("coalesce(sum(_n) OVER (PARTITION BY g ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("_start"),
        F.expr("sum(_n) OVER (PARTITION BY g)").alias("n"))
    return dealt.join(stored(runs, "runs"), ["_part", "g"]) \
        .select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_start")).alias("i"), "n")


def _slots(fanout: int) -> list[str]:
    return [f"c{s}" for s in range(fanout)]


def pivot(nodes: DataFrame, fanout: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """The parents of ``nodes`` (g, i, n, h): (g, i, n, h) and the children's structs c0, c1, ..."""
    child = F.struct("h", *carry)
    slot = F.pmod(F.col("i"), F.lit(fanout))
    spread = nodes.groupBy("g", F.expr(f"i div {fanout}").alias("i")).agg(
        F.max("n").alias("n"), *[F.max(F.when(slot == s, child)).alias(c) for s, c in enumerate(_slots(fanout))])
    return spread.select("g", "i", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
                         F.sha2(F.concat_ws("", *[f"{c}.h" for c in _slots(fanout)]).cast("binary"), 256).alias("h"), *_slots(fanout))


def levels(leaves: DataFrame, fanout: int = FANOUT, carry: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """(parents of level 1, 2, ..., the groups' subroots as (g, depth, h))."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    tops, found, now, depth = [], [], leaves, 0
    while True:
        tops.append(now.where("n = 1").select("g", F.lit(depth).alias("depth"), "h"))
        if most <= 1:
            return found, reduce(DataFrame.unionByName, tops)
        now = stored(pivot(now.where("n > 1"), fanout, carry if depth == 0 else ()), "level")
        found.append(now)
        most, depth = -(-most // fanout), depth + 1


def children(parents: DataFrame, fanout: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """The children's rows (g, i, h, path) of parents with their path: a child's siblings, then the parent's."""
    def row(s: int) -> Column:
        left, right = (F.concat_ws("", *[f"{c}.h" for c in part]) for part in (_slots(fanout)[:s], _slots(fanout)[s + 1:]))
        step = F.struct(left.alias("left"), right.alias("right"))
        child = F.struct((F.col("i") * fanout + s).alias("i"), F.col(f"c{s}.h").alias("h"), F.concat(F.array(step), "path").alias("path"),
                         *[F.col(f"c{s}.{c}").alias(c) for c in carry])
        return F.when(F.col(f"c{s}").isNotNull(), child)

    return parents.select("g", F.explode(F.array_compact(F.array(*[row(s) for s in range(fanout)]))).alias("_")).select("g", "_.*")


def paths(leaves: DataFrame, found: list[DataFrame], tops: DataFrame, fanout: int = FANOUT, carry: tuple[str, ...] = ()) -> DataFrame:
    """(g, i, h, path, carry) of every leaf; ``tops``: (g, depth, path) of the groups' subroots."""
    def top(depth: int) -> DataFrame:
        return tops.where(F.col("depth") == depth).select("g", F.lit(0).cast("long").alias("i"), "path")

    depth, known = len(found), top(len(found))
    while depth:
        rows = children(found[depth - 1].drop("h").join(known, ["g", "i"]), fanout, carry if depth == 1 else ())
        depth -= 1
        if depth:
            known = stored(rows.select("g", "i", "path").unionByName(top(depth)), "paths")
    alone = leaves.where("n = 1").join(top(0).drop("i"), "g").select("g", "i", "h", "path", *carry)
    return alone.unionByName(rows.select(*alone.columns)) if found else alone


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, start, lambda h, p: digest(p["left"], h, p["right"]))


def path_digest(path: Column) -> Column:
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def manifest(rows: DataFrame, carry: tuple[str, ...] = (), fanout: int = FANOUT, order: tuple[str, ...] = ("id", "h")) -> DataFrame:
    """Each row's leaf with its way to the root: (g, id, h, subroot, root, path, carry).

    ``rows``: (g, id, h, carry) with the group by :func:`group_key` and the leaf's digest h.
    """
    carry = ("id", *carry)
    leaves = stored(numbered(stored(rows.select("g", "h", *carry), "leaves"), list(order)), "places")
    found, tops = levels(leaves, fanout, carry)
    tops = stored(tops, "subroots")
    # the tree over the subroots: one group, in the order of the groups
    above = stored(numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("of"), "h"), ["of"]), "places")
    found_above, root = levels(above, fanout, ("of",))
    root = root.select("g", F.col("h").alias("root"), "depth", F.array().cast(_PATH).alias("path"))
    up = paths(above, found_above, root, fanout, ("of",)).join(root.select("g", "root"), "g")
    tops = stored(tops.join(up.select(F.col("of").alias("g"), "path", "root"), "g"), "subroots")
    return paths(leaves, found, tops.select("g", "depth", "path"), fanout, carry) \
        .join(tops.select("g", F.col("h").alias("subroot"), "root"), "g").drop("i")


def tampered(text: Column, doc_id: Column) -> Column:
    """What tampering makes of the text: in rows whose id's crc32 three divides, A-Z are lower-cased."""
    return F.when(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 0, ascii_lower(text)).otherwise(text)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*LEAF_COLUMNS)
    whole = [F.col(c) for c in LEAF_COLUMNS]
    changed = [tampered(F.col("text"), F.col("doc_id")) if c == "text" else F.col(c) for c in LEAF_COLUMNS]
    rows = docs.select(group_key(F.col("lang")).alias("g"), F.col("doc_id").alias("id"), leaf(whole).alias("h"), leaf(changed).alias("h2"))
    out = manifest(rows, ("h2",)).withColumn("folded_root", fold(F.col("h2"), F.col("path")))
    return out.select(F.col("id").alias("doc_id"), F.col("h").alias("leaf"), "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql(fanout: int = FANOUT, leaf_levels: int = 12, top_levels: int = 4) -> str:
    """DuckDB: a level is a window over the one before; enough levels for 8^12 rows in 8^4 languages."""
    def framed_sql(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    low = f"translate(text, '{'ABCDEFGHIJKLMNOPQRSTUVWXYZ'}', '{'abcdefghijklmnopqrstuvwxyz'}')"
    leaf_sql = lambda text: "sha256(" + " || ".join(framed_sql(text if c == "text" else c) for c in LEAF_COLUMNS) + ")"
    # DuckDB has no crc32: the digits' bytes folded in, each by eight halvings
    crc = ("list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::UBIGINT)), "
           "lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), "
           "lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))")
    ctes = [f"docs AS (SELECT *, CASE WHEN xor({crc}, 4294967295::UBIGINT) % 3 = 0 THEN {low} ELSE text END AS changed FROM documents)",
            f"base AS (SELECT coalesce('1' || lang, '0') AS g, doc_id, {leaf_sql('text')} AS leaf, {leaf_sql('changed')} AS leaf2 FROM docs)",
            "a0 AS (SELECT g, leaf AS h, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,"
            " count(*) OVER (PARTITION BY g) AS n FROM base)",
            "f0 AS (SELECT g, doc_id, leaf, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,"
            " leaf2 AS f, '' AS proof FROM base)"]

    def climb(name: str, fold_name: str, count: int) -> None:
        run = f"PARTITION BY g, i // {fanout} ORDER BY i ROWS BETWEEN"
        for k in range(count):
            ctes.append(f"{name}s{k} AS (SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
                        f" coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})")
            ctes.append(f"{name}{k + 1} AS (SELECT g, i // {fanout} AS i, (max(n) + {fanout - 1}) // {fanout} AS n,"
                        f" CASE WHEN max(n) = 1 THEN max(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} GROUP BY g, i // {fanout})")
            ctes.append(f"{fold_name}{k + 1} AS (SELECT x.* REPLACE (x.i // {fanout} AS i, CASE WHEN s.n = 1 THEN x.f ELSE sha256(s.l || x.f || s.r) END AS f,"
                        f" CASE WHEN s.n = 1 THEN x.proof ELSE x.proof || s.l || s.r END AS proof) FROM {fold_name}{k} x JOIN {name}s{k} s USING (g, i))")

    climb("a", "f", leaf_levels)
    ctes.append(f"b0 AS (SELECT '' AS g, g AS of, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM a{leaf_levels})")
    ctes.append(f"u0 AS (SELECT '' AS g, b.i, x.doc_id, x.leaf, x.f, x.proof, b.h AS subroot FROM f{leaf_levels} x JOIN b0 b ON x.g = b.of)")
    climb("b", "u", top_levels)
    return (f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, (SELECT h FROM b{top_levels}) AS root, sha256(proof) AS proof_sha256,"
            f" f AS folded_root, f = (SELECT h FROM b{top_levels}) AS verified FROM u{top_levels}")


SQL = _sql()
