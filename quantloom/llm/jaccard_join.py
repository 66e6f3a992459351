"""Operator 12: an n-gram Jaccard join of texts by prefix trees over globally ordered sets.

A text's set holds a hash per distinct shingle. The sets are ordered by how many sets hold a shingle, rarest first, and
each group of sets that may link is stored in a prefix tree, which a probe descends with its overlap so far: sets with a
common beginning share it, and a subtree is left when the overlap and what remains of either side can't reach the
threshold for any size in it. Subtrees whose sets are connected with the probe already are left too, as the result is
components; so a group of near-copies costs a link a set, not one a pair.

Three steps of Spark bring sets that may link together, each exact:

1. A set links with no other if over a fifth of its shingles stand in no other set. That is counted on the shingles
   whose hashes lie in the lowest 30 %, which most texts fail by far; the rest are counted again on all their shingles.
2. Two sets that link share a shingle among the first of their order (the prefix filter); components over such shared
   shingles are the groups.
3. A group too long for a task is dealt into chunks by hash. What links within chunks is replaced by one member until that
   no longer shrinks it; then each shingle of the prefixes that still joins unconnected members is a tree of its own, or one for each two
   chunks of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.llm.jobs import components, cut, join_hot, table
from quantloom.llm.text import arrow_rows, in_pieces, joined, mix, span_hash, utf8, word_bounds

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M = np.uint64(0xD6E8FEB86659FD93)
#: Of all hash values, those whose shingles are counted first.
_COUNTED = 30
_LIMIT = np.uint64(_COUNTED * (1 << 64) // 100)
#: Bits of a shingle's hash below its class of frequency.
_CODE_BITS = 57


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; one of the whole text where it has fewer words."""
    for a, b in in_pieces(texts, 1 << 21):
        buf, offsets = joined([t.translate(_LOWER) for t in texts[a:b]])
        starts, ends = word_bounds(buf)
        bounds = np.searchsorted(starts, offsets)
        word = span_hash(buf, starts, ends)
        padded, code = np.concatenate((word, np.zeros(size, np.uint64))), np.zeros(len(word), np.uint64)
        for k in range(size):
            code = code * _M + padded[k : k + len(word)]
        code = mix(code)
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if last - first >= size:
                yield np.unique(code[first : last - size + 1])
            elif last > first:
                yield np.array([xxhash.xxh3_64_intdigest(word[first:last].tobytes())], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def _name(tokens: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(xxhash.xxh3_128_digest(tokens.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])


def _named(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per text its number of shingles and the name of its set."""
    kind = pa.struct([("k1", pa.int64()), ("k2", pa.int64())])
    for batch in batches:
        told = [(len(s), *_name(s)) for s in shingle_sets(utf8(batch.column("text")), size)]
        names = pa.array([{"k1": k1, "k2": k2} for _, k1, k2 in told], kind)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rk"), pa.array([n for n, *_ in told], pa.int64()), names], ["doc_id", "rk", "n", "set"])


def _counted(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The shingles of the lowest hashes, with (half of) the names of their sets."""
    for batch in batches:
        sets = list(shingle_sets(utf8(batch.column("text")), size))
        low = [s[: np.searchsorted(s, _LIMIT)] for s in sets]
        names = np.array([_name(s)[0] for s in sets], np.int64)
        h = np.concatenate(low) if low else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.repeat(names, [len(s) for s in low]))], ["h", "k1"])


def _whole(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The sets of rows (sid, n, set, text) whose names are as told, each once."""
    seen: set[int] = set()
    for batch in batches:
        sets = list(shingle_sets(utf8(batch.column("text")), size))
        sids, told = batch.column("sid").to_pylist(), [(x["k1"], x["k2"]) for x in batch.column("set").to_pylist()]
        at = [i for i, s in enumerate(sets) if _name(s) == told[i] and not (sids[i] in seen or seen.add(sids[i]))]
        yield pa.RecordBatch.from_arrays([*batch.select(["sid", "n"]).take(pa.array(at, pa.int64())).columns, pa.array([sets[i].view(np.int64) for i in at], pa.list_(pa.int64()))], ["sid", "n", "tokens"])


class PrefixTree:
    """A prefix tree of sets in their order; nodes breadth first, so that the children of one are consecutive.

    ranks: ascending token numbers of each set; sizes: their sizes, tokens that no other set has included.
    """

    def __init__(self, ranks: list[np.ndarray], sizes: np.ndarray):
        keys = [r.astype(">u4").tobytes() for r in ranks]
        self.order = np.array(sorted(range(len(ranks)), key=keys.__getitem__), np.int64)
        self.sets, self.sizes = [ranks[i] for i in self.order], sizes[self.order]
        common = np.zeros(len(ranks) + 1, np.int64)
        for i in range(1, len(ranks)):
            a, b = self.sets[i - 1], self.sets[i]
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            common[i] = differ[0] if len(differ) else m
        self._build(common)

    def _build(self, common: np.ndarray) -> None:
        queue, lens = [(0, len(self.sets), 0, 0, 0)], np.array([len(s) for s in self.sets])
        nodes, edges, done = [], [], 0
        while done < len(queue):
            lo, hi, begin, end, piece = queue[done]
            # A long edge is cut, so that a probe may leave it early.
            stop = min(end, begin + (32, 128)[piece]) if piece < 2 else end
            first = len(queue)
            if stop < end:
                queue.append((lo, hi, stop, end, piece + 1))
            elif hi - lo > 1 or not done:
                starts = [lo, *(lo + 1 + np.flatnonzero(common[lo + 1 : hi] == end)).tolist(), hi]
                for a, b in zip(starts, starts[1:], strict=False):
                    queue.append((a, b, end, int(common[a + 1 : b].min()) if b - a > 1 else len(self.sets[a]), 0))
            edge = self.sets[lo][begin:stop]
            edges.append(edge)
            nodes.append((lo, hi, first, len(queue) - first, len(edge), self.sets[lo][stop - 1] if stop else -1, self.sizes[lo:hi].min(), self.sizes[lo:hi].max(), lens[lo:hi].max() - stop))
            done += 1
        self.lo, self.hi, self.first, self.kids, self.width, self.last, self.least, self.most, self.left = np.array(nodes, np.int64).T
        self.pool = np.concatenate(edges)
        self.at = np.cumsum(self.width) - self.width

    def links(self, label: np.ndarray, vocabulary: int) -> list[tuple[int, int]]:
        """Links that, with label (equal where sets are connected), connect what all links would. label follows self.order and is changed."""
        found, mark = [], np.zeros(vocabulary, bool)
        changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))

        def link(i: int, j: int) -> None:
            nonlocal changes
            found.append((i, j))
            label[label == label[i]] = label[j]
            changes = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))

        for i in range(1, len(self.sets)):
            # Sets next to each other in the order share most; a link here spares the descent.
            if label[i] != label[i - 1]:
                o = len(np.intersect1d(self.sets[i], self.sets[i - 1], assume_unique=True))
                if 9 * o >= 4 * (self.sizes[i] + self.sizes[i - 1]):
                    link(i, i - 1)
        for i in range(1, len(self.sets)):
            if not changes[i]:
                continue
            x, n = self.sets[i], self.sizes[i]
            smallest, largest = -(-4 * n // 5), 5 * n // 4
            mark[x] = True
            node, overlap = np.zeros(1, np.int64), np.zeros(1, np.int64)
            while len(node):
                kids = self.kids[node]
                node, overlap = _ranges(self.first[node], kids), np.repeat(overlap, kids)
                lo, up_to = self.lo[node], np.minimum(self.hi[node], i) - 1
                new = (lo < i) & (self.most[node] >= smallest) & (self.least[node] <= largest)
                new &= (label[lo] != label[i]) | (changes[np.maximum(up_to, lo)] != changes[lo])
                node, overlap = node[new], overlap[new]
                shared = np.concatenate(([0], np.cumsum(mark[self.pool[_ranges(self.at[node], self.width[node])]])))
                ends = np.cumsum(self.width[node])
                overlap = overlap + shared[ends] - shared[ends - self.width[node]]
                rest = np.minimum(len(x) - np.searchsorted(x, self.last[node], "right"), self.left[node])
                possible = 9 * (overlap + rest) >= 4 * (n + np.maximum(self.least[node], smallest))
                node, overlap = node[possible], overlap[possible]
                leaf = self.kids[node] == 0
                for j, o in zip(self.lo[node[leaf]].tolist(), overlap[leaf].tolist(), strict=True):
                    if label[i] != label[j] and 9 * o >= 4 * (n + self.sizes[j]):
                        link(i, j)
                node, overlap = node[~leaf], overlap[~leaf]
            mark[x] = False
        return found


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def tree_links(sid: np.ndarray, label: np.ndarray, sizes: np.ndarray, codes: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the sets of one group, as pairs of sid."""
    pool = np.concatenate(codes)
    values, ranks = np.unique(pool, return_inverse=True)
    cuts = np.cumsum([len(c) for c in codes])[:-1]
    tree = PrefixTree(np.split(ranks, cuts), sizes)
    mine = sid[tree.order]
    return [(int(mine[i]), int(mine[j])) for i, j in tree.links(np.unique(label, return_inverse=True)[1][tree.order], len(values))]


def _group_links(group: pa.Table) -> pa.Table:
    """Links within each tree of a task."""
    tree, sid, label, sizes = (group.column(c).to_numpy() for c in ("tree", "sid", "label", "n"))
    codes = group.column("codes").combine_chunks()
    codes = codes if isinstance(codes, pa.Array) else pa.concat_arrays(codes.chunks)
    offsets, flat = codes.offsets.to_numpy(), codes.values.to_numpy()
    order, found = np.lexsort((sid, tree)), []
    bounds = np.flatnonzero(np.diff(tree[order], prepend=tree[order[0]] - 1, append=tree[order[-1]] + 1)) if len(order) else []
    for a, b in zip(bounds, bounds[1:], strict=False):
        at = order[a:b]
        # The two chunks of a pair may be one.
        at = at[np.concatenate(([True], np.diff(sid[at]) != 0))]
        if len(at) > 1:
            found += _stars(tree_links(sid[at], label[at], sizes[at], [flat[offsets[i] : offsets[i + 1]] for i in at.tolist()]))
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def _stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Each node of the links with the smallest one that it reaches."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    for a, b in links:
        lo, hi = sorted((find(a), find(b)))
        root[hi] = lo
    return [(x, r) for x in root if (r := find(x)) != x]


def _trees(members: DataFrame, task_cost: int = 1 << 18) -> DataFrame:
    """Links (a, b) of members (tree, label, sid, n, codes), per tree stars around the smallest sid; trees are dealt to tasks by hash."""
    total = members.agg(F.sum(_cost())).first()[0] or 0
    tasks = max(512, -(-int(total) // task_cost))
    dealt = members.select(F.pmod(F.xxhash64("tree"), F.lit(tasks)).alias("task"), F.xxhash64("tree").alias("tree"), "label", "sid", "n", "codes")
    return dealt.groupBy("task").applyInArrow(_group_links, "a long, b long")


def _cost():
    return F.size("codes") + 256


def set_links(sets: DataFrame, *, tree_cost: int = 1 << 18) -> DataFrame:
    """Links (a, b) that connect sets (sid, n, codes: ascending tokens that other sets have) as all pairs of similarity 0.8 or more would.

    A tree holds sets of at most about tree_cost tokens (256 added a set), whatever the groups are.
    """
    # Of the first n // 5 + 1 tokens the ones that no other set has come first and can't be shared.
    prefix = F.slice("codes", F.lit(1), (F.floor(F.col("n") / 5) + 1 - (F.col("n") - F.size("codes"))).cast("int"))
    entries = cut(sets.select("sid", _cost().alias("cost"), F.explode(prefix).alias("code")))
    lists = entries.groupBy("code").agg(F.count("*").alias("n"), F.min("sid").alias("least")).where("n > 1")
    edges = join_hot(entries, cut(lists), "code", entries.count()).where("sid <> least").select(F.col("sid").alias("a"), F.col("least").alias("b"))
    groups = cut(components(edges).join(sets.select(F.col("sid").alias("node"), _cost().alias("cost")), "node").select(F.col("node").alias("sid"), F.col("root").alias("g"), "cost"))
    costs = cut(groups.groupBy("g").agg(F.sum("cost").alias("whole"), F.count("*").alias("n")))
    placed = join_hot(groups.select("sid", "g"), costs, "g", groups.count())
    grouped = cut(sets.join(placed, "sid").withColumn("label", F.col("sid")))
    links = _trees(grouped.where(F.col("whole") <= tree_cost).withColumn("tree", F.struct("g")))
    if costs.where(F.col("whole") > tree_cost).limit(1).count():
        links = links.unionByName(_long_groups(grouped.where(F.col("whole") > tree_cost).drop("whole"), entries.drop("cost"), tree_cost))
    return links


def _chunks(costs: DataFrame, tree_cost: int) -> DataFrame:
    return costs.withColumn("chunks", F.ceil(F.col("cost") / tree_cost).cast("int"))


def _long_groups(members: DataFrame, entries: DataFrame, tree_cost: int) -> DataFrame:
    """The links of groups that are too long for a tree. members are their sets (sid, g, label, n, codes)."""
    links, left, before = None, members, None
    while True:
        costs = cut(_chunks(left.groupBy("g").agg(F.sum(_cost()).alias("cost"), F.count("*").alias("n")).where("n > 1"), tree_cost))
        now, most = costs.agg(F.sum("n"), F.max("chunks")).first()
        if not now or before and now > before // 2:
            break
        before = now
        found = cut(_trees(_dealt(left, costs, now)))
        links = found if links is None else links.unionByName(found)
        if most == 1:
            break
        left = cut(left.join(found.select(F.col("a").alias("sid")), "sid", "left_anti"))
    # What hangs together so far, as stars.
    stars = components(links)
    members = cut(members.drop("label").join(stars.select(F.col("node").alias("sid"), F.col("root").alias("label")), "sid", "left").withColumn("label", F.coalesce("label", "sid")))
    # Prefix tokens that join members which aren't connected yet.
    told = cut(entries.join(members.select("sid", "label", _cost().alias("cost")), "sid"))
    lists = told.groupBy("code").agg(F.sum("cost").alias("cost"), F.count("*").alias("n"), F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1")
    lists = cut(_chunks(lists, tree_cost).select("code", "n", "chunks"))
    dealt = join_hot(told.select("code", "sid"), lists, "code", told.count()).withColumn("i", F.pmod(F.xxhash64("sid"), F.col("chunks")).cast("int"))
    # Each two chunks of a list share a tree.
    other = dealt.select("sid", "code", "i", "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j")).where("i <> j OR chunks = 1")
    trees = other.select("sid", F.struct("code", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).alias("tree"))
    found = _trees(trees.join(members.select("sid", "label", "n", "codes"), "sid"))
    return stars.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found)


def _dealt(left: DataFrame, costs: DataFrame, rows: int) -> DataFrame:
    """The sets of each group dealt into as many trees as it has chunks."""
    held = left.withColumnRenamed("n", "size")
    chunk = F.pmod(F.xxhash64("sid", F.lit(rows)), F.col("chunks"))
    return join_hot(held, costs.select("g", "n", "chunks"), "g", rows).select("sid", "label", F.col("size").alias("n"), "codes", F.struct("g", chunk.alias("i")).alias("tree"))


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, tree_cost: int = 1 << 18, broadcast_rows: int = 200_000) -> DataFrame:
    """The component of each document over links between texts whose shingle sets have a Jaccard similarity of 0.8 or more.

    Returns a row per row of docs: doc_id, n_shingles and component_id, the smallest doc_id that it reaches. Texts are
    lower-cased (A-Z); a text with fewer words than a shingle is one shingle. Hashes of 64 bits stand for shingles, names of 128 bits for sets.

    A null text, or one without words, is linked with nothing. Equal sets are one class, whatever their number; repeated
    rows and ids give a row each. A null id never names a component. Empty docs give no rows. Other columns are ignored,
    whatever their names. Rows to read again are told by a broadcast of at most broadcast_rows, beyond that by a shuffled join.
    """
    arrow_rows(docs.sparkSession)
    doc_id, text = F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    rows = docs.select(doc_id, text).withColumn("rk", F.xxhash64("doc_id", "text"))
    told = cut(rows.mapInArrow(partial(_named, size=shingle), "doc_id long, rk long, n long, set struct<k1:long,k2:long>"))
    classes = cut(told.where("n > 0").groupBy("set").agg(F.first("n").alias("size"), F.min("doc_id").alias("least"), F.min("rk").alias("rk"), F.count("*").alias("n")))
    shared = rows.select("text").mapInArrow(partial(_counted, size=shingle), "h long, k1 long").groupBy("h").agg(F.min("k1").alias("k1"), F.max("k1").alias("k2"))
    alone = shared.where("k1 = k2").groupBy("k1").agg(F.count("*").alias("alone"))
    suspects = classes.join(alone, F.col("set.k1") == F.col("k1"), "left").where("5 * coalesce(alone, 0) <= size")
    suspects = cut(suspects.select("rk", "set", F.monotonically_increasing_id().alias("sid"), F.col("size").alias("n"), "least"))
    few = suspects.count() <= broadcast_rows
    wanted = suspects.select("rk", "sid", "n", "set")
    again = rows.select("rk", "text").join(F.broadcast(wanted) if few else wanted, "rk").select("sid", "n", "set", "text")
    tokens = cut(again.mapInArrow(partial(_whole, size=shingle), "sid long, n long, tokens array<long>")).select("sid", F.col("n").alias("size"), F.explode("tokens").alias("h"))
    n_tokens = suspects.agg(F.sum("n")).first()[0] or 0
    # Rarest first: the number of bits of a count, then the hash.
    code = F.shiftleft(F.length(F.bin("n")).cast("long"), _CODE_BITS).bitwiseOR(F.col("h").bitwiseAND(F.lit((1 << _CODE_BITS) - 1)))
    counts = cut(tokens.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h", "n", code.alias("code")))
    listed = join_hot(tokens, counts, "h", n_tokens).groupBy("sid", "size").agg(F.array_sort(F.collect_set("code")).alias("codes"))
    sets = cut(listed.select("sid", F.col("size").alias("n"), "codes").where("5 * (n - size(codes)) <= n"))
    roots = components(set_links(sets, tree_cost=tree_cost))
    linked = suspects.join(roots.withColumnRenamed("node", "sid"), "sid").select("set", "root", "least")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    linked = cut(join_hot(linked.select("set", "root"), least, "root", suspects.count()).select("set", "component_id"))
    of_set = classes.join(linked, "set", "left").select("set", "n", F.coalesce("component_id", "least").alias("component_id"))
    placed = join_hot(told.where("n > 0").select("doc_id", F.col("n").alias("n_shingles"), "set"), cut(of_set), "set", told.count())
    return placed.select("doc_id", "n_shingles", "component_id").unionByName(told.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words
), texts AS (SELECT s, min(doc_id) AS id FROM sets WHERE len(s) > 0 GROUP BY s),
shingles AS (SELECT id, len(s) AS n, unnest(s) AS x FROM texts),
links AS (
    SELECT a.id AS a, b.id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.id <> b.id
    GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE coalesce(root, id) END AS component_id
FROM sets LEFT JOIN texts USING (s) LEFT JOIN roots USING (id)"""
