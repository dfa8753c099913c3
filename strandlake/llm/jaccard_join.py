"""N-gram Jaccard self-join by adaptive multi-match prefixes.

Tokens of a document are its distinct word shingles under one global order: rare first, as a fixed-size count sketch
of the whole corpus estimates, then by hash. Two sets that reach the threshold share at least m tokens of their
m-prefixes (the first |x| - ceil(t|x|) + m tokens). Each document picks its own m by estimated cost: a longer prefix
emits more postings, but asks of each candidate that many more shared tokens. A pair is verified when its shared
prefix tokens reach the smaller m and the bound on the overlap that the rest of both sets can still add.

Documents with equal sets form one class, and only classes are joined. Tokens shared by over ``dense`` classes are
not expanded into all their pairs: their classes are first linked to a hub, those left outside its component to a few
more, and afterwards only pairs across the components found are compared, which loses no component. Tokens that the
sketch holds for frequent are spread over many tasks from the start.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import Bloom
from .common import documents, record, scratch, slices, stored, table, text_buffer, trimmed
from .graph import components
from .words import U64, mix, shingle_sets, words

#: Counters of the frequency sketch and of its blocks; its size is fixed whatever the corpus holds.
SKETCH, BLOCK = 1 << 22, 1 << 16
#: Classes that a worker remembers as already emitted; beyond it only more duplicates reach the shuffle.
REMEMBERED = 1 << 18
#: Sets that the sketch must estimate for a token before it is spread, and the tasks it is spread over.
FREQUENT, SPREAD = 1024, 64


def class_key(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a token set."""
    if not len(tokens):
        return 0
    power = np.arange(1, len(tokens) + 1, dtype=U64)
    return int(mix(np.array([mix(tokens * U64(2) + power).sum() + U64(len(tokens))], U64)).astype(np.int64)[0])


def sets_of(batches, size: int):
    """(doc ids, token sets) of each slice; ids may hold None."""
    for part in slices(batches):
        hashes, bounds = shingle_sets(words(*text_buffer(part.column(1))), size)
        yield part.column(0), [hashes[bounds[i] : bounds[i + 1]] for i in range(part.num_rows)]


class Once:
    """True for keys that were not asked about lately."""

    def __init__(self):
        self.keys: set[int] = set()

    def __call__(self, key: int) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= REMEMBERED:
            self.keys.clear()
        self.keys.add(key)
        return True


def frequency_sketch(docs: DataFrame, size: int) -> np.ndarray:
    """SKETCH counters over all documents' tokens: summed per task, then per block of counters, 16 MB in all."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        total, once = np.zeros(SKETCH, np.int32), Once()
        for _, sets in sets_of(batches, size):
            kept = [s for s in sets if len(s) and once(class_key(s))]
            if kept:
                np.add.at(total, (np.concatenate(kept) & U64(SKETCH - 1)).astype(np.int64), np.int32(1))
        blocks = total.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(axis=1))
        yield record("block long,counts binary", used, pa.array([zlib.compress(blocks[b].tobytes(), 1) for b in used], pa.binary()))

    def add(batches) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                total.setdefault(b, np.zeros(BLOCK, np.int64)).__iadd__(np.frombuffer(zlib.decompress(raw.as_py()), np.int32))
        yield record("block long,counts binary", list(total), pa.array([zlib.compress(np.minimum(v, 2**31 - 1).astype(np.int32).tobytes(), 1) for v in total.values()], pa.binary()))

    ddl = "block long,counts binary"
    summed = docs.mapInArrow(trimmed(count), ddl).repartition(SKETCH // BLOCK, "block").mapInArrow(trimmed(add), ddl)
    out = np.zeros(SKETCH, np.int32)
    for row in summed.collect():
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(zlib.decompress(row.counts), np.int32)
    return out


def prefix(tokens: np.ndarray, counts: np.ndarray, load: float, percent: int, most: int) -> tuple[np.ndarray, int]:
    """(prefix tokens, m) of one set. The m of 1..most with the least estimated cost wins.

    Cost: one unit for each posting that the prefix tokens meet, and eight for each candidate; a candidate must meet
    m of the prefix tokens, so there are at most as many as postings divided by m.
    """
    n = len(tokens)
    seen = counts[(tokens & U64(SKETCH - 1)).astype(np.int64)]
    order = np.lexsort((tokens, seen))
    base = n - -(-percent * n // 100)
    met = np.cumsum(np.maximum(seen[order] - load, 0.1))
    m = np.arange(1, min(most, n - base) + 1)
    postings = met[base + m - 1]
    best = int(m[np.argmin(postings * (1 + 8 / m))])
    return tokens[order[: base + best]], best


def classes(docs: DataFrame, size: int = 5) -> DataFrame:
    """(doc_id, cls, n_shingles) of every row, and row_hash of its text; an empty set has cls 0."""
    ddl = "doc_id long,cls long,n_shingles long,row_hash long"

    def run(batches):
        for part in slices(batches):
            (_, sets), = sets_of([part], size)
            yield record(ddl, part.column(0), [class_key(s) for s in sets], [len(s) for s in sets], part.column(2))

    return docs.withColumn("row_hash", F.xxhash64("text")).mapInArrow(trimmed(run), ddl)


def postings(docs: DataFrame, counts, load: float, size: int, percent: int, most: int) -> DataFrame:
    """(token, cls, n, m, rank, salt): prefix tokens of each class; rank is higher for sets of commoner prefix tokens.

    salt is 0, or for frequent tokens a number above it by the class.
    """
    ddl = "token long,cls long,n int,m int,rank int,salt int"

    def run(batches):
        once = Once()
        for _, sets in sets_of(batches, size):
            token, cls, n, m, rank, salt = [], [], [], [], [], []
            for s in sets:
                if not len(s) or not once(key := class_key(s)):
                    continue
                first, best = prefix(s, counts.value, load, percent, most)
                token.append(first)
                k = len(first)
                seen = counts.value[(first & U64(SKETCH - 1)).astype(np.int64)]
                common = int(np.log2(1 + seen).mean() * 1000)
                cls.append(np.full(k, key, np.int64))
                n.append(np.full(k, len(s), np.int32))
                m.append(np.full(k, best, np.int32))
                rank.append(np.full(k, common, np.int32))
                salt.append(np.where(seen > load + FREQUENT, 1 + key % SPREAD, 0).astype(np.int32))
            if token:
                yield record(ddl, np.concatenate(token).view(np.int64), *map(np.concatenate, (cls, n, m, rank, salt)))

    return docs.mapInArrow(trimmed(run), ddl)


def _groups(batches, dense: int):
    """Rows (token, cls, n, m, rank) of each token, from batches sorted by token, as arrays, and whether it is dense.

    A token of over ``dense`` classes comes in parts, none gathered beyond the batch it is in. A class may come twice.
    """
    rest, crowded = None, False
    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        free = now[5] > 0
        if free.any():
            yield [c[free] for c in now[:5]], True
            now = [c[~free] for c in now]
        if not len(now[0]):
            continue
        now = now[:5]
        if rest is not None:
            crowded = crowded and now[0][0] == rest[0][0]
            now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(now[0])) + 1, [len(now[0])]))
        for at, to in zip(cuts[:-2], cuts[1:-1], strict=True):
            if crowded or to - at > 1:
                rows = [c[at:to] for c in now]
                yield rows, crowded or len(np.unique(rows[1])) > dense
            crowded = False
        rest = [c[cuts[-2] :] for c in now]
        if crowded or len(np.unique(rest[1])) > dense:
            yield rest, True
            rest, crowded = [c[-1:] for c in rest], True  # one row tells the token on
    if rest is not None and not crowded and len(rest[0]) > 1:
        yield rest, False


def meet(shared: DataFrame, percent: int, dense: int) -> DataFrame:
    """Pairs of classes under each token, or the token's classes themselves where there are over ``dense`` of them.

    kind 0: (a, b) share the token; kind 1: a is a class of the dense token b, with the columns of a; it may come twice.
    """
    ddl = "kind int,a long,b long,na int,nb int,ma int,mb int,rank int"
    low, high = np.tril_indices(dense, -1)

    def run(batches):
        out, held = [], 0
        for (token, cls, n, m, rank), crowded in _groups(batches, dense):
            if crowded:
                out.append((np.ones(len(cls), np.int32), cls, token, n, n, m, m, rank))
            else:
                cls, at = np.unique(cls, return_index=True)
                k = len(cls)
                n, m, rank = n[at], m[at], rank[at]
                i, j = high[: k * (k - 1) // 2], low[: k * (k - 1) // 2]
                ok = 100 * np.minimum(n[i], n[j]).astype(np.int64) >= percent * np.maximum(n[i], n[j]).astype(np.int64)
                i, j = i[ok], j[ok]
                out.append((np.zeros(len(i), np.int32), cls[i], cls[j], n[i], n[j], m[i], m[j], rank[i]))
            held += len(out[-1][0])
            if held > 50_000:
                yield record(ddl, *map(np.concatenate, zip(*out, strict=True)))
                out, held = [], 0
        if out:
            yield record(ddl, *map(np.concatenate, zip(*out, strict=True)))

    return shared.mapInArrow(trimmed(run), ddl)


def _needed(percent: int):
    """Shared prefix tokens below which a pair can't reach the threshold: the smaller m, and the positional bound."""
    overlap = F.ceil(F.lit(percent) * (F.col("na") + F.col("nb")) / F.lit(100.0 + percent) - F.lit(1e-9))
    rest = F.greatest(*[F.ceil(F.col(f"n{s}") * percent / F.lit(100.0) - F.lit(1e-9)) - F.col(f"m{s}") for s in "ab"])
    return F.greatest(F.least("ma", "mb"), overlap - rest)


def token_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(cls, tokens): the token set of each class in ``wanted`` (cls), and of a few others.

    Which documents to send is decided where they are read, by a filter of fixed size.
    """
    hit = Bloom(wanted)

    def run(batches):
        once = Once()
        for _, sets in sets_of(batches, size):
            keys = np.array([class_key(s) for s in sets], np.int64)
            kept = [i for i in np.flatnonzero(hit.has(keys)) if keys[i] and once(int(keys[i]))]
            if kept:
                yield record("cls long,tokens binary", keys[kept], pa.array([sets[i].tobytes() for i in kept], pa.binary()))

    return docs.mapInArrow(trimmed(run), "cls long,tokens binary").dropDuplicates(["cls"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) of pairs whose sets reach the threshold, with the sizes of intersection and union."""
    ddl = "a long,b long,both long,either long"

    def run(batches):
        for batch in batches:
            both, either = [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                either.append(len(x) + len(y) - both[-1])
            ok = np.flatnonzero(100 * np.array(both, np.int64) >= percent * np.array(either, np.int64))
            yield record(ddl, *(batch.column(c).take(pa.array(ok)) for c in (0, 1)), np.array(both, np.int64)[ok], np.array(either, np.int64)[ok])

    x, y = (sets.select(F.col("cls").alias(s), F.col("tokens").alias(f"t{s}")) for s in "ab")
    return pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "ta", "tb").mapInArrow(trimmed(run), ddl)


def links(docs: DataFrame, size: int = 5, percent: int = 80, most: int = 4, dense: int = 32, hubs: int = 4) -> DataFrame:
    """Links (a, b) between classes that give the same components as all pairs at the threshold."""
    spark = docs.sparkSession
    counts = frequency_sketch(docs, size)
    load = float(counts.mean())
    sent = spark.sparkContext.broadcast(counts)
    sorted_postings = postings(docs, sent, load, size, percent, most).repartition("token", "salt").sortWithinPartitions("token")
    met = stored(meet(sorted_postings, percent, dense), "met")
    crowd = met.where("kind = 1").select(F.col("b").alias("token"), F.col("a").alias("cls"), F.col("na").alias("n"), F.col("ma").alias("m"), "rank")
    crowd = stored(crowd.dropDuplicates(["token", "cls"]), "crowd")
    counted = met.where("kind = 0").groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"), *[F.first(c).alias(c) for c in ("na", "nb", "ma", "mb")])
    counted = stored(counted, "counted")
    crowded = crowd.groupBy("cls").agg(F.count(F.lit(1)).alias("crowded"))
    pairs = counted
    for side in "ab":
        pairs = pairs.join(crowded.select(F.col("cls").alias(side), F.col("crowded").alias(f"c{side}")), side, "left")
    near = F.col("k") + F.least(F.coalesce("ca", F.lit(0)), F.coalesce("cb", F.lit(0))) >= _needed(percent)
    done = stored(pairs.where(near).select("a", "b"), "pairs")
    wanted = done.select(F.explode(F.array("a", "b")).alias("cls")).unionAll(crowd.select("cls")).distinct()
    sets = stored(token_sets(docs, wanted, size), "sets")
    found = stored(verified(done, sets, percent).select("a", "b"), "links")
    if crowd.isEmpty():
        return found
    # Dense tokens: their classes meet one of them, those outside its component a few more, then only pairs across components.
    for turn in range(2):
        rows, ends = _outside(crowd, stored(components(found), "labels"), hubs) if turn else (crowd, _hub(crowd.join(crowded, "cls"), "crowded"))
        stars = rows.join(ends, "token").where(f"cls <> hub AND 100 * least(n, hub_n) >= {percent} * greatest(n, hub_n)")
        stars = stars.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
        stars = stored(stars, "stars")
        found = found.unionAll(stored(verified(stars, sets, percent).select("a", "b"), "links"))
        done = done.unionAll(stars)
    label = stored(components(found), "labels")
    cross = _across(crowd, label, percent).join(done, ["a", "b"], "left_anti")
    return found.unionAll(stored(verified(cross, sets, percent).select("a", "b"), "links"))


def _across(crowd: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes in different components that dense tokens alone can bring to the threshold.

    Pairs that share other tokens, too, were compared before if they could reach it with all dense tokens of either.
    The dense tokens of each class are ordered, those of fewer classes first. Of a pair that needs q of them, the first
    that both have is among all but the last q - 1 of either, so classes meet on those alone, and not at all where one
    of them has under q. The pair's tokens are then counted from both lists, which are parts of prefixes.
    """
    sizes = crowd.groupBy("token").agg(F.count(F.lit(1)).alias("classes"))
    lists = crowd.join(sizes, "token").groupBy("cls", "n", "m").agg(F.sort_array(F.collect_list(F.struct("classes", "token"))).alias("own"))
    lists = lists.join(label.withColumnRenamed("node", "cls"), "cls", "left")
    lists = lists.select("cls", "n", "m", F.coalesce("component", "cls").alias("comp"), F.col("own.token").alias("own"))
    lists = stored(lists, "dense")
    each = lists.select("cls", "n", "m", "comp", F.size("own").alias("size"), F.posexplode("own").alias("pos", "token"))
    held = each.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("classes"))
    held = held.groupBy("token").agg(F.max(F.struct("classes", "comp"))["comp"].alias("most"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    each = each.join(held.select("token", "most"), "token").withColumn("outside", F.col("comp") != F.col("most"))
    # A class meets each band of partner sizes apart, so that how many tokens a pair needs is known on either side.
    each = each.withColumn("band", F.floor(F.log("n") / F.log(F.lit(1.01)) + F.lit(1e-9)).cast("int"))
    bands = each.groupBy("token", F.col("band").alias("with")).agg(F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min("m").alias("least_m"))
    each = each.join(bands, "token").where(f"100 * n >= {percent} * least_n AND 100 * most_n >= {percent} * n")
    overlap = F.ceil(F.lit(percent) * (F.col("n") + F.col("least_n")) / F.lit(100.0 + percent) - F.lit(1e-9))
    rest = F.greatest(F.ceil(F.col("n") * percent / F.lit(100.0) - F.lit(1e-9)) - F.col("m"), F.ceil(F.col("most_n") * percent / F.lit(100.0) - F.lit(1e-9)) - F.col("least_m"))
    least = F.greatest(F.least("m", "least_m"), overlap - rest, F.lit(1))
    each = each.where(F.col("pos") <= F.col("size") - least).withColumn("low", F.least("band", "with")).withColumn("high", F.greatest("band", "with"))
    x = each.where("outside").select("token", "low", "high", F.col("cls").alias("a"), F.col("comp").alias("compa"))
    y = each.select("token", "low", "high", F.col("cls").alias("b"), F.col("comp").alias("compb"), "outside")
    pairs = x.join(y, ["token", "low", "high"]).where("compa <> compb AND (NOT outside OR a < b)")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for side in "ab":
        pairs = pairs.join(lists.select(*[F.col(c).alias(f"{t}{side}") for c, t in (("cls", ""), ("n", "n"), ("m", "m"), ("own", "own"))]), side)
    sizes = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    return pairs.where(sizes & (F.size(F.array_intersect("owna", "ownb")) >= _needed(percent))).select("a", "b")


def _hub(rows: DataFrame, *first: str) -> DataFrame:
    """(token, hub, hub_n): the class of each token that is greatest by the columns ``first``, then by rank."""
    best = rows.groupBy("token").agg(F.max(F.struct(*first, "rank", "n", "cls")).alias("h"))
    return best.select("token", F.col("h.cls").alias("hub"), F.col("h.n").alias("hub_n"))


def _outside(crowd: DataFrame, label: DataFrame, hubs: int) -> tuple[DataFrame, DataFrame]:
    """Rows of each token outside its largest component, and its hubs: ``hubs`` of that component, and one outside it."""
    rows = crowd.join(label.withColumnRenamed("node", "cls"), "cls", "left").withColumn("comp", F.coalesce("component", "cls"))
    held = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("classes"))
    held = held.groupBy("token").agg(F.max(F.struct("classes", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    rows = rows.join(held, "token")
    outside = rows.where("comp <> main")
    drawn = rows.where("comp = main").groupBy("token").agg(F.array(*[F.min(F.struct(F.xxhash64("cls", F.lit(i)), "n", "cls")) for i in range(hubs)]).alias("h"))
    drawn = drawn.select("token", F.explode("h").alias("h")).select("token", F.col("h.cls").alias("hub"), F.col("h.n").alias("hub_n"))
    return outside.select("token", "cls", "n"), drawn.unionAll(_hub(outside)).distinct()


def _labelled(docs: DataFrame, size: int, percent: int, most: int, dense: int) -> tuple[DataFrame, DataFrame]:
    """classes of docs as stored, and (cls, label): equal for the classes of a component, null for one without links."""
    own = stored(classes(docs, size), "classes")
    with scratch(docs.sparkSession):
        label = stored(components(links(docs, size, percent, most, dense)).select(F.col("node").alias("cls"), F.col("component").alias("label")), "labels", keep=True)
    return own, label


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80, most: int = 4, dense: int = 32) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: components of documents linked at Jaccard >= percent / 100.

    Words are lower-cased (A-Z) runs of non-space bytes; a set holds the distinct ``size``-word shingles, or the whole
    sequence of a shorter text. Null or wordless text: n_shingles 0, linked with nothing, its own component. Equal
    sets are linked. Repeated rows each get a row; a null doc_id stays null and counts as the largest id when a
    component is named. Other columns of df are ignored. An empty table gives an empty result.
    """
    own, label = _labelled(documents(df, id_col, text_col), size, percent, most, dense)
    least = own.where("cls <> 0").groupBy("cls").agg(F.min("doc_id").alias("low"))
    named = least.join(label, "cls", "left").select("cls", "low", F.coalesce("label", "cls").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(lowest, "component").select("cls", "component_id")
    full = own.where("cls <> 0").join(named, "cls", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return full.unionAll(own.where("cls = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without near copies: of each component one row stays, with all its columns; rows without words all stay.

    It is the row with the smallest id (null is the largest), of equal ids the one with the smallest hash of its text.
    Rows are judged by id and text together, so that rows that share an id, or have none, each stay or go by their own
    text. Of repeated rows, equal in id and text, one stays.
    """
    docs = documents(df, id_col, text_col)
    own, label = _labelled(docs, 5, 80, 4, 32)
    keys = own.where("cls <> 0").groupBy("cls", "doc_id", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
    keys = keys.join(label, "cls", "left").withColumn("component", F.coalesce("label", "cls"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")
    best = keys.groupBy("component").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("held"), F.max("copies").alias("copies")).where("held > 1 OR copies > 1")
    judged = keys.drop("copies").join(best, "component").withColumn("stays", rank == F.col("best"))
    gone = judged.where("NOT stays").select(F.col("doc_id").alias("_gone"), F.col("row_hash").alias("_hash"))
    again = keys.where("copies > 1").select(F.col("doc_id").alias("_gone"), F.col("row_hash").alias("_hash"))
    rows = df.withColumn("_row_hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    match = F.col(id_col).cast("long").eqNullSafe(F.col("_gone")) & (F.col("_row_hash") == F.col("_hash"))
    left = rows.join(gone, match, "left_anti")
    if again.limit(1).count():
        left = left.join(again, match, "left_anti").unionByName(left.join(again, match, "left_semi").dropDuplicates([id_col, "_row_hash"]))
    return left.select(*df.columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


#: Rows of equal sets go as one class; links join classes, and ``reach`` follows them.
OP4_SQL = r"""with recursive d as (select row_number() over (order by doc_id) as n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
 u as (select n, unnest(w) as x, generate_subscripts(w, 1) as i from d where len(w) >= 5),
 g as (select n, x || ' ' || lead(x, 1) over p || ' ' || lead(x, 2) over p || ' ' || lead(x, 3) over p || ' ' || lead(x, 4) over p as s from u window p as (partition by n order by i)),
 s as materialized (select distinct n, s from g where s is not null union all select n, array_to_string(w, ' ') from d where len(w) between 1 and 4),
 e as materialized (select n, sha256(string_agg(s, chr(10) order by s)) as cls, count(*) as c from s group by n),
 k as materialized (select cls, min(n) as r, any_value(c) as c from e group by cls),
 t as materialized (select k.r, k.c, s.s from k join s on s.n = k.r),
 l as materialized (select a.r as x, b.r as y from t a join t b on a.s = b.s and a.r < b.r group by a.r, b.r, a.c, b.c having 100 * count(*) >= 80 * (a.c + b.c - count(*))),
 v as materialized (select x, y from l union all select y, x from l),
 reach as (select r as x, r as y from k union select reach.x, v.y from reach join v on v.x = reach.y),
 m as materialized (select k.r, min(d.doc_id) as low from k join e on e.cls = k.cls join d on d.n = e.n group by k.r),
 f as (select reach.x as r, min(m.low) as component_id from reach join m on m.r = reach.y group by reach.x)
 select d.doc_id, coalesce(e.c, 0)::bigint as n_shingles, coalesce(f.component_id, d.doc_id)::bigint as component_id from d left join e on e.n = d.n left join k on k.cls = e.cls left join f on f.r = k.r"""
