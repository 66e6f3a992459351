"""Operator 11: a Merkle manifest of a dataset by time-forward processing.

The nodes of a tree are labelled in post-order, (last leaf below, level), so children come before their parent. A sweep
in label order visits the leaves; an inner node is visited when the queue's least message is addressed to it, takes its
children's digests from the queue and sends its own to its parent. Post-order keeps the queue at one run of messages a
level. Of a sweep over all of a corpus only the queue crosses tasks, and Spark is its external part: the leaves of a
tree are cut into blocks of 16**3, each swept within a task; the messages that leave a block, one digest each, are
written and dealt out by label again as the leaves of the next round. A round divides the nodes by 4,096.

Each visited node is written with the digests that it took. The reversed sweep reads them in descending order: a node
takes its own proof from the queue and sends each child the siblings followed by it, down to the leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantloom.llm.jobs import cut, packed, table
from quantloom.llm.text import arrow_rows

#: Nodes of a run, the levels that a task sweeps in one round, and the leaves of a block.
FAN_BITS, LEVELS = 4, 3
BLOCK_BITS = FAN_BITS * LEVELS
HEX = 64

PROOF = "array<struct<left:string,right:string>>"
UP = "g long, block long, hi long, level int, size long, kids string, top string"

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 (lowercase hex) of the values, each written as its UTF-8 byte count, a colon and itself, or as - if null."""
    told = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*told), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the leaf's to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _levels(size: int) -> int:
    """Levels above size leaves, as far as one round goes."""
    return min(LEVELS, -(-(size - 1).bit_length() // FAN_BITS))


def sweep_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves (g, pos, size, digest), by g and pos, to the inner nodes of their blocks with the digests that each took.

    The topmost node of a block comes with its own digest, the message that leaves the block. A block that is a single
    leaf of a tree with no levels gives that leaf as its top.
    """
    queue: list[tuple[int, int, int, int, str, int]] = []
    for batch in batches:
        found: list[tuple] = []
        for g, pos, size, digest in zip(*(batch.column(c).to_pylist() for c in ("g", "pos", "size", "digest")), strict=True):
            _visit_until(queue, (g, pos, 0), found)
            if _levels(size):
                heappush(queue, (g, pos | 15, 1, pos, digest, size))
            else:
                found.append((g, pos >> BLOCK_BITS, pos, 0, size, None, digest))
        yield _rows(found)
    found = []
    _visit_until(queue, None, found)
    yield _rows(found)


def _visit_until(queue: list, label: tuple | None, found: list) -> None:
    """Visits the inner nodes whose labels come before label (None: all)."""
    while queue and (label is None or queue[0][:3] < label):
        node, kids = queue[0][:3], []
        while queue and queue[0][:3] == node:
            *_, digest, size = heappop(queue)
            kids.append(digest)
        (g, hi, level), taken = node, "".join(kids)
        digest, is_top = hashlib.sha256(taken.encode()).hexdigest(), level == _levels(size)
        found.append((g, hi >> BLOCK_BITS, hi, level, size, taken, digest if is_top else None))
        if not is_top:
            heappush(queue, (g, hi | ((1 << FAN_BITS * (level + 1)) - 1), level + 1, hi, digest, size))


def _rows(found: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string())
    columns = zip(*found, strict=True) if found else [[]] * 7
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["g", "block", "hi", "level", "size", "kids", "top"])


def sweep_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block, by descending label: the message to its top, inner nodes and leaves; returns the leaves with their proofs.

    A message is a proof so far, as linked steps that the nodes below share, and the digests of the tops passed.
    """
    queue: list[tuple[int, int, tuple | None]] = []
    tops: list[str] = []
    for batch in batches:
        at, proofs, ends = [], [], []
        names = ("kind", "hi", "level", "kids", "proof", "tops")
        for i, (kind, hi, level, kids, proof, passed) in enumerate(zip(*(batch.column(c).to_pylist() for c in names), strict=True)):
            if kind == 0:
                steps = None
                for step in reversed(proof):
                    steps = ((step["left"], step["right"]), steps)
                queue, tops = [(-hi, -level, steps)], passed
                continue
            _, _, steps = heappop(queue)
            if level:
                first, width = hi + 1 - (1 << FAN_BITS * level), 1 << FAN_BITS * (level - 1)
                for k in range(len(kids) // HEX):
                    step = (kids[: k * HEX], kids[(k + 1) * HEX :])
                    heappush(queue, (-(first + (k + 1) * width - 1), 1 - level, (step, steps)))
            else:
                at.append(i)
                ends.append(tops)
                told = []
                while steps:
                    told.append({"left": steps[0][0], "right": steps[0][1]})
                    steps = steps[1]
                proofs.append(told)
        kept = batch.select(["g", "pos", "row"]).take(pa.array(at, pa.int64()))
        step = pa.struct([("left", pa.string()), ("right", pa.string())])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(proofs, pa.list_(step)), pa.array(ends, pa.list_(pa.string()))], ["g", "pos", "row", "proof", "tops"])


def _next_leaves(tape: DataFrame) -> DataFrame:
    """The messages that leave a round's blocks, as the leaves of the next round."""
    return tape.where("top IS NOT NULL").select("g", F.col("block").alias("pos"), F.ceil(F.col("size") / (1 << BLOCK_BITS)).cast("long").alias("size"), F.col("top").alias("digest"))


def climb(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of the sweep over trees of leaves (g, pos, size, digest): the nodes of each round, and (g, top) per tree."""
    most, tapes = leaves.agg(F.max("size")).first()[0] or 0, []
    while True:
        dealt = leaves.repartition(F.col("g"), F.shiftright("pos", BLOCK_BITS)).sortWithinPartitions("g", "pos")
        tapes.append(cut(dealt.mapInArrow(sweep_up, UP)))
        leaves, most = _next_leaves(tapes[-1]), -(-most >> BLOCK_BITS) if most > 1 << BLOCK_BITS else 1
        if most <= 1:
            break
        # A tree that is done has one leaf left, which stays as it is in the rounds of the others.
    return tapes, leaves.select("g", F.col("digest").alias("top"))


def descend(tapes: list[DataFrame], leaves: DataFrame, messages: DataFrame) -> DataFrame:
    """The reversed sweep: messages (g, proof, tops) to the tops of trees become rows (g, pos, row, proof, tops) of their leaves.

    leaves are those that climb took, with a struct row that is kept.
    """
    kind = leaves.schema["row"].dataType.simpleString()
    none = lambda t: F.lit(None).cast(t)
    messages = messages.select("g", F.lit(0).cast("long").alias("block"), "proof", "tops")
    for n, tape in reversed(list(enumerate(tapes))):
        if n:
            below = _next_leaves(tapes[n - 1]).select("g", "pos", none(kind).alias("row"))
        else:
            below = leaves.select("g", "pos", "row")
        tops = tape.where("top IS NOT NULL").select("g", "block", "hi", "level")
        heads = messages.join(tops, ["g", "block"]).select("g", "block", "hi", "level", F.lit(0).alias("kind"), none("string").alias("kids"), "proof", "tops", none("long").alias("pos"), none(kind).alias("row"))
        nodes = tape.where("level > 0").select("g", "block", "hi", "level", F.lit(1).alias("kind"), "kids", none(PROOF).alias("proof"), none("array<string>").alias("tops"), none("long").alias("pos"), none(kind).alias("row"))
        ends = below.select("g", F.shiftright("pos", BLOCK_BITS).alias("block"), F.col("pos").alias("hi"), F.lit(0).alias("level"), F.lit(1).alias("kind"), none("string").alias("kids"), none(PROOF).alias("proof"), none("array<string>").alias("tops"), "pos", "row")
        told = heads.unionByName(nodes).unionByName(ends).repartition("g", "block").sortWithinPartitions("g", "block", "kind", F.desc("hi"), F.desc("level"))
        found = told.mapInArrow(sweep_down, f"g long, pos long, row {kind}, proof {PROOF}, tops array<string>")
        if n:
            messages = cut(found.select("g", F.col("pos").alias("block"), "proof", "tops"))
    return found


def numbered(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """rows with part (a task's range of the order by, *order) and pos (the number of a row within its by); size and g as well.

    g numbers the values of by in their order, null first, and size counts the rows of one. rows must be a written
    table. Ranges are counted, so no task gathers a value; rows that are equal in all of order keep an order of their own.
    """
    keys = [by, *order, "__tie"]
    dealt = cut(rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))
    ranged = dealt.withColumn("part", F.shiftright("__at", 33))
    spans = ranged.groupBy(by, "part").agg(F.count("*").alias("n"), F.min("__at").alias("first"))
    w = Window.partitionBy(by)
    spans = spans.select(by, "part", "first", F.sum("n").over(w).alias("size"), F.coalesce(F.sum("n").over(w.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    spans = cut(spans)
    known = spans.select(by).distinct().repartitionByRange(by).sortWithinPartitions(by).withColumn("__n", F.monotonically_increasing_id())
    known = cut(known)
    starts = known.groupBy(F.shiftright("__n", 33).alias("p")).agg(F.count("*").alias("n"))
    starts = starts.select("p", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("g0"))
    known = known.join(starts, F.shiftright("__n", 33) == F.col("p")).select(by, (F.col("g0") + F.col("__n").bitwiseAND(F.lit((1 << 33) - 1))).alias("g"))
    spans = spans.alias("s").join(known.alias("k"), F.col(f"s.{by}").eqNullSafe(F.col(f"k.{by}"))).select("s.*", "g")
    placed = ranged.alias("r").join(spans.alias("s"), F.col(f"r.{by}").eqNullSafe(F.col(f"s.{by}")) & (F.col("r.part") == F.col("s.part")))
    return placed.select(*[f"r.{c}" for c in rows.columns], "g", "size", (F.col("__at") - F.col("first") + F.col("before")).alias("pos"))


def merkle_manifest(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, keep: dict[str, Column] | None = None) -> DataFrame:
    """A Merkle tree over the rows of docs, with each row's proof.

    Each row is a leaf, the digest of fields. Per group the leaves ascend by id; every 16 consecutive nodes become one,
    until the subroot remains; the subroots, by group, give the root in the same way. Returns a row per row of docs:
    doc_id, source, leaf, subroot, root, proof (per level from the leaf up, the siblings to its left and to its right,
    hex digests one after the other) and the columns of keep, which are made of those of docs.

    A null id comes first in its group and a null group first of all; a null field has a digest of its own. Rows with
    equal ids are ordered by their leaves; repeated rows are leaves each. Empty docs give no rows. Other columns are
    ignored, whatever their names. Only digests are shuffled, never texts; a hot group is many blocks.
    """
    arrow_rows(docs.sparkSession)
    kept = F.struct(F.lit(0).alias("__none"), *[c.alias(name) for name, c in (keep or {}).items()])
    rows = cut(docs.select(F.col(f"`{group_col}`").cast("string").alias("source"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("leaf"), kept.alias("kept")))
    placed = numbered(rows, "source", ["doc_id", "leaf"])
    leaves = cut(placed.select("g", "pos", "size", F.col("leaf").alias("digest"), F.struct("doc_id", "source", "leaf", "kept").alias("row")))
    tapes, subroots = climb(leaves)
    n = leaves.agg(F.max("g")).first()[0]
    heads = cut(subroots.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("pos"), F.lit(0 if n is None else n + 1).cast("long").alias("size"), F.col("top").alias("digest"), F.struct(F.col("top")).alias("row")))
    top_tapes, roots = climb(heads)
    start = roots.select("g", F.array().cast(PROOF).alias("proof"), F.array("top").alias("tops"))
    told = cut(descend(top_tapes, heads, start).select(F.col("pos").alias("g"), "proof", F.concat(F.array("row.top"), F.col("tops")).alias("tops")))
    found = descend(tapes, leaves, told)
    return found.select("row.doc_id", "row.source", "row.leaf", F.col("tops")[0].alias("subroot"), F.col("tops")[1].alias("root"), "proof", *[F.col(f"row.kept.`{c}`").alias(c) for c in keep or {}])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    tampered = leaf_digest(*[text if c == "text" else F.col(c) for c in FIELDS])
    found = merkle_manifest(table(spark, sf_dir, "documents"), keep={"tampered": tampered})
    found = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), folded(F.col("tampered"), F.col("proof")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


_SIXTEENTH = """
    SELECT level + 1 AS level, g, pos // 16 AS pos, (n + 15) // 16 AS n, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
    FROM {name} WHERE n > 1 GROUP BY level, g, pos // 16, n"""

OP11_SQL = f"""
WITH RECURSIVE polynomial AS (
    SELECT i, 0 AS step, i::BIGINT AS v FROM range(256) t(i)
    UNION ALL SELECT i, step + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM polynomial WHERE step < 8
), crc_table AS (SELECT list(v ORDER BY i) AS t FROM polynomial WHERE step = 8),
told AS (
    SELECT row_number() OVER () AS id, doc_id, source, text, concat(
        {", ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1])}) AS head,
        xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
            lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)])), 4294967295) % 5 = 0 AS hit
    FROM documents, crc_table
), rows_ AS (
    SELECT id, doc_id, source, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(strlen(text)::VARCHAR || ':' || CASE WHEN hit THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END, '-')) AS tampered
    FROM told
), placed AS (
    SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, id) - 1 AS pos
    FROM rows_
), low AS (SELECT 0 AS level, g, pos, n, leaf AS digest FROM placed UNION ALL {_SIXTEENTH.format(name="low")}),
subroots AS (SELECT g, level AS height, digest AS subroot FROM low WHERE n = 1),
high AS (SELECT 0 AS level, 0 AS g, g AS pos, (SELECT count(*) FROM subroots) AS n, subroot AS digest FROM subroots UNION ALL {_SIXTEENTH.format(name="high")}),
root AS (SELECT digest AS root FROM high WHERE n = 1),
nodes AS (SELECT 0 AS tree, level, g, pos, digest FROM low WHERE n > 1 UNION ALL SELECT 1, level, 0, pos, digest FROM high WHERE n > 1),
runs AS (SELECT tree, level, g, pos // 16 AS run, list(digest ORDER BY pos) AS kids FROM nodes GROUP BY ALL),
steps AS (
    SELECT id, r.tree, r.level, kids[:p.pos // (16 ** r.level)::BIGINT % 16] AS l, kids[p.pos // (16 ** r.level)::BIGINT % 16 + 2:] AS r
    FROM placed p JOIN runs r ON r.tree = 0 AND r.g = p.g AND r.run = p.pos // (16 ** (r.level + 1))::BIGINT
    UNION ALL
    SELECT id, r.tree, r.level, kids[:p.g // (16 ** r.level)::BIGINT % 16], kids[p.g // (16 ** r.level)::BIGINT % 16 + 2:]
    FROM placed p JOIN runs r ON r.tree = 1 AND r.run = p.g // (16 ** (r.level + 1))::BIGINT
), proofs AS (
    SELECT id, list(array_to_string(l, '') ORDER BY tree, level) AS l, list(array_to_string(r, '') ORDER BY tree, level) AS r FROM steps GROUP BY id
), folds AS (
    SELECT p.id, 0 AS k, tampered AS digest, coalesce(l, []) AS l, coalesce(r, []) AS r FROM placed p LEFT JOIN proofs USING (id)
    UNION ALL SELECT id, k + 1, sha256(l[k + 1] || digest || r[k + 1]), l, r FROM folds WHERE k < len(l)
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(range(1, len(l) + 1), lambda i: l[i] || r[i]), '')) AS proof_sha256,
    digest AS folded_root, digest = root AS verified
FROM folds JOIN placed USING (id) JOIN subroots USING (g), root WHERE k = len(l)"""
