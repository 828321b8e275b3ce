"""Near copies among embeddings: pruned flat graphs over overlapping cluster shards, searched greedily by range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import bounded_batches, components, discard, shared, store

THRESHOLD = 0.95
# vectors in a shard that one task builds and searches, at most; larger shards are split again
SHARD_ROWS = 2048
CENTRES = 32
# vectors that the centres of a split are fitted on, about
SAMPLE_ROWS = 4096
# two clusters of a sample are one, and a shard is proved dense, if this share of the pairs is linked
PROVED = 0.25
# a dense shard of which a split leaves more than this share together is compared in blocks instead
DENSE = 0.8
# splits after which a shard that does not fall apart is compared in blocks, and after which every one is
TRIED_SPLITS, MOST_SPLITS = 6, 12
# independent partitionings: at least, at most, and the audited recall from which no more are added
LEAST_RUNS, MOST_RUNS, TARGET = 2, 8, 0.97
# edges of a node after pruning, candidates before it, and the factor by which a detour may be longer
DEGREE, CANDIDATES, ALPHA = 24, 64, 1.2
BEAM = 16
# the range search goes on from nodes this far below the threshold
SLACK = 0.1
# vectors that the audit compares with all others
AUDITED = 1000
# nodes whose neighbours are looked at together, and queries that search together
OPENED, QUERIES = 1 << 14, 512


def unit(column):
    """An Arrow list column as a matrix of unit rows in double precision."""
    import numpy as np

    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = values.reshape(len(flat), -1)
    # scaled first, so that squares of very large or small components stay finite
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def centres_of(matrix, run: int):
    """k-means by Euclidean distance, so that a direction that all vectors share does not matter: centres, and whether the
    vectors are a dense ball.

    Clusters whose vectors are mostly linked with each other keep one centre, so that a dense ball is not cut up. Later
    runs stop early, so that their borders lie elsewhere.
    """
    import numpy as np

    random = np.random.default_rng([len(matrix), run])
    centres = matrix[random.choice(len(matrix), min(CENTRES, len(matrix)), replace=False)]
    for _ in range(2 if run else 8):
        mine = nearness(matrix, centres).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, mine, matrix)
        size = np.bincount(mine, minlength=len(centres))[:, None]
        centres = np.where(size > 0, sums / np.maximum(size, 1), centres)
    mine = nearness(matrix, centres).argmax(axis=1)
    member = np.zeros((len(matrix), len(centres)), np.float32)
    member[np.arange(len(matrix)), mine] = 1
    links = np.zeros((len(centres), len(centres)))
    for low in range(0, len(matrix), 512):
        near = (matrix[low : low + 512] @ matrix.T >= THRESHOLD).astype(np.float32)
        links += member[low : low + 512].T @ (near @ member)
    size = member.sum(axis=0)
    share = links / np.maximum(np.outer(size, size), 1)
    kept: list[int] = []
    for i in np.argsort(-size, kind="stable").tolist():
        if size[i] and not (share[i, kept] >= PROVED).any():
            kept.append(i)
    return centres[kept], links.sum() >= PROVED * len(matrix) ** 2


def nearness(matrix, centres):
    """A value that falls as the distance of a row to a centre grows, for every row and centre."""
    return matrix @ centres.T - (centres**2).sum(axis=1) / 2


def split(members: DataFrame, level: int, run: int, spent: list[DataFrame]) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Members (shard, home, id, v) as finished, dense and still too large shards.

    Large shards are split by centres fitted on a hashed sample of their members. Members meet the centres in groups of
    shard and salt, so that no group is larger than a shard may be. A member also goes to its second centre where a
    vector linked with it can have that as its first. `spent` takes the tables stored on the way.
    """
    import numpy as np
    import pyarrow as pa

    reach = float(np.sqrt(2 - 2 * THRESHOLD))
    sizes = members.groupBy("shard").agg(F.count("*").alias("n"), F.count_if("home").alias("n_home"))
    sizes = store(sizes, "sizes")
    spent.append(sizes)
    big = sizes.filter(F.col("n") > SHARD_ROWS)
    done = members.join(big.select("shard"), "shard", "left_anti")
    if big.isEmpty():
        return done, None, None
    if level >= MOST_SPLITS:
        return done, members.join(big.select("shard"), "shard", "left_semi"), None
    rows = members.join(big, "shard").withColumn("hash", F.xxhash64("id", F.lit(level), F.lit(run)))
    fraction = F.shiftrightunsigned("hash", 11) / float(1 << 53)
    sample = rows.filter(fraction < SAMPLE_ROWS / F.col("n")).select("shard", "v")

    def fit(table: pa.Table) -> pa.Table:
        centres, dense = centres_of(unit(table.column("v")), run)
        k = len(centres)
        shard = [table.column("shard")[0].as_py()] * k
        return pa.table({"shard": shard, "number": range(k), "centre": centres.tolist(), "proved": [bool(dense)] * k})

    schema = "shard string, number long, centre array<double>, proved boolean"
    centres = store(sample.groupBy("shard").applyInArrow(fit, schema), "centres")
    salts = F.ceil(F.col("n") / SHARD_ROWS).cast("int")
    salted = rows.withColumn("salt", F.pmod("hash", salts).cast("int")).select("shard", "salt", "home", "id", "v")
    copies = centres.join(big, "shard").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    copies = copies.select("shard", "salt", "number", "centre")

    def place(own: pa.Table, table: pa.Table) -> pa.Table:
        if not own.num_rows:
            return own.select(["shard", "home", "id", "v"])
        # centres are means of unit vectors, and stay as they are
        table = table.sort_by("number")
        flat = table.column("centre").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        centre = flat.reshape(table.num_rows, -1)
        near = nearness(unit(own.column("v")), centre)
        order = np.argsort(-near, axis=1, kind="stable")[:, :2]
        rank = np.zeros(len(near), np.int64)
        at = np.arange(len(near))
        if order.shape[1] > 1:
            lead = np.take_along_axis(near, order, 1)
            apart = np.linalg.norm(centre[order[:, 0]] - centre[order[:, 1]], axis=1)
            extra = np.flatnonzero(lead[:, 0] - lead[:, 1] <= reach * apart)  # the distance to the plane between both
            at, rank = np.concatenate([at, extra]), np.concatenate([rank, np.ones(len(extra), np.int64)])
        up = own.column("shard")[0].as_py()
        names = [f"{up}.{c}" for c in order[at, rank].tolist()]
        home = own.column("home").to_numpy()[at] & (rank == 0)
        taken = own.select(["id", "v"]).take(pa.array(at))
        return pa.table({"shard": names, "home": home, "id": taken.column("id"), "v": taken.column("v")})

    schema = "shard string, home boolean, id long, v array<double>"
    placed = salted.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt")).applyInArrow(place, schema)
    placed = store(placed.select("shard", "home", "id", "v"), "members")
    # a shard stays whole if most of its home members went one way
    up = F.substring_index("shard", ".", level + 1).alias("up")
    ways = placed.filter("home").groupBy("shard").agg(F.count("*").alias("n"))
    ways = ways.groupBy(up).agg(F.max("n").alias("most"))
    proved = centres.groupBy("shard").agg(F.max("proved").alias("proved"))
    whole = ways.join(big, ways.up == big.shard).drop("up").join(proved, "shard")
    stuck = F.col("proved") | F.lit(level >= TRIED_SPLITS)
    whole = store(whole.filter((F.col("most") > DENSE * F.col("n_home")) & stuck).select("shard"), "dense")
    spent += [centres, placed, whole]
    dense = members.join(whole, "shard", "left_semi")
    split_up = placed.select("*", up).join(whole.select(F.col("shard").alias("up")), "up", "left_anti").drop("up")
    return done, dense, split_up


def neighbours(matrix):
    """The pruned graph of a shard: a row of neighbours per node, -1 where there are fewer than DEGREE.

    Of a node's nearest candidates the nearest is kept, and those go that it is nearer to, by ALPHA, than the node is.
    """
    import numpy as np

    n = len(matrix)
    graph = np.full((n, DEGREE), -1, np.int64)
    k = min(CANDIDATES, n - 1)
    for low in range(0, n, 512):
        rows = np.arange(low, min(low + 512, n))
        near = matrix[rows] @ matrix.T
        near[np.arange(len(rows)), rows] = -2
        if k < 1:
            break
        picked = np.argpartition(-near, k - 1, axis=1)[:, :k]
        order = np.argsort(-np.take_along_axis(near, picked, 1), axis=1)
        picked = np.take_along_axis(picked, order, 1)
        reach = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(near, picked, 1), 0))
        open_, every = np.ones(picked.shape, bool), np.arange(len(rows))
        for slot in range(DEGREE):
            live = open_.any(axis=1)
            if not live.any():
                break
            first = open_.argmax(axis=1)
            chosen = picked[every, first]
            graph[rows[live], slot] = chosen[live]
            between = np.einsum("rkd,rd->rk", matrix[picked], matrix[chosen])
            detour = ALPHA * np.sqrt(np.maximum(2 - 2 * between, 0))
            open_ &= detour > reach
            open_[every, first] = False
    return graph


def searched(matrix, graph, queries, start: int):
    """Whether each query (row numbers) found each node at THRESHOLD or more, as a matrix.

    A beam walks from `start` towards the query; then every node within SLACK of the threshold opens its neighbours,
    until none is new. Only nodes that were reached are compared.
    """
    import numpy as np

    n, found = len(matrix), np.zeros((len(queries), len(matrix)), bool)
    for low in range(0, len(queries), QUERIES):
        own = queries[low : low + QUERIES]
        b = len(own)
        every = np.arange(b)
        seen, near = np.zeros((b, n), bool), np.full((b, n), -2.0)

        def visit(q, nodes, own=own, seen=seen, near=near):
            """Compare pairs of query and node that are new; those pairs."""
            pairs = np.unique(q * n + nodes)
            q, nodes = pairs // n, pairs % n
            fresh = ~seen[q, nodes]
            q, nodes = q[fresh], nodes[fresh]
            for at in range(0, len(q), 1 << 16):
                part = slice(at, at + (1 << 16))
                near[q[part], nodes[part]] = np.einsum("pd,pd->p", matrix[own[q[part]]], matrix[nodes[part]])
            seen[q, nodes] = True
            return q, nodes

        visit(every, np.full(b, start))
        beam = np.full((b, BEAM), -1, np.int64)
        beam[:, 0] = start
        opened = np.zeros((b, n), bool)
        while True:
            value = np.where(beam >= 0, near[every[:, None], beam], -3)
            value[(beam >= 0) & opened[every[:, None], beam]] = -3
            best = value.argmax(axis=1)
            q = np.flatnonzero(value[every, best] > -3)
            if not len(q):
                break
            node = beam[q, best[q]]
            opened[q, node] = True
            next_ = graph[node]
            new_q, new = visit(np.repeat(q, graph.shape[1])[next_.ravel() >= 0], next_.ravel()[next_.ravel() >= 0])
            if len(new):
                place = np.arange(len(new_q)) - np.searchsorted(new_q, new_q)
                wide = np.full((b, BEAM + graph.shape[1]), -1, np.int64)
                wide[:, :BEAM] = beam
                wide[new_q, BEAM + place] = new
                score = np.where(wide >= 0, near[every[:, None], wide], -3)
                order = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
                beam = np.take_along_axis(wide, order, 1)
        waiting = [np.nonzero(seen & (near >= THRESHOLD - SLACK))]
        while waiting:
            q, nodes = waiting.pop()
            if len(q) > OPENED:  # some at a time, as each brings all its neighbours
                waiting.append((q[OPENED:], nodes[OPENED:]))
                q, nodes = q[:OPENED], nodes[:OPENED]
            next_ = graph[nodes]
            real = next_.ravel() >= 0
            q, nodes = visit(np.repeat(q, graph.shape[1])[real], next_.ravel()[real])
            close = near[q, nodes] >= THRESHOLD - SLACK
            if close.any():
                waiting.append((q[close], nodes[close]))
        found[low : low + QUERIES] = near >= THRESHOLD
    found[np.arange(len(queries)), queries] = False
    return found


def roots_of(linked):
    """The smallest reachable number of every node of a symmetric matrix of links."""
    import numpy as np

    root = np.arange(len(linked))
    while True:
        least = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(root, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


RESULT = "kind string, a long, b long, n long"
# what a task knows of a member: its copies, its home shard in every run, and all its shards
MARKS = ("n", "homes", "seen")


def met(table):
    """For each run, a matrix that tells whether the column's member is in the home shard of the row's member."""
    import numpy as np

    homes = np.array(table.column("homes").to_pylist(), np.int64)
    seen = table.column("seen").combine_chunks()
    width = np.diff(seen.offsets.to_numpy())
    shards, at = np.unique(seen.flatten().to_numpy(), return_inverse=True)
    inside = np.zeros((len(homes), len(shards)), bool)
    inside[np.repeat(np.arange(len(homes)), width), at] = True
    return [inside[:, np.searchsorted(shards, homes[:, run])].T for run in range(homes.shape[1])]


def results(table, linked):
    """Rows of links of a shard: `count` a has n direct links more, `edge` a and b are connected.

    linked: members by members, set where a search from the row found the column. Every home member counts what it found.
    A visitor is counted a home member only where its own home shard has not got that. Pairs that met in an earlier
    run were counted there, so a link counts once, and no pair has to be written.
    """
    import numpy as np
    import pyarrow as pa

    ids, home, copies = (table.column(c).to_numpy() for c in ("id", "home", "n"))
    both = linked & home[:, None]
    both |= (both & home[None, :]).T
    root = roots_of(both | both.T)
    moved = np.flatnonzero(root != np.arange(len(root)))
    *earlier, now = met(table)
    for before in earlier:
        both &= ~(before | before.T)
    counts = both @ copies + (both & ~home[None, :] & ~now.T).T @ copies
    some = np.flatnonzero(counts)
    zero = np.zeros(len(some), np.int64)
    return pa.table(
        {
            "kind": pa.array(["count"] * len(some) + ["edge"] * len(moved), pa.string()),
            "a": np.concatenate([ids[some], ids[moved]]).astype(np.int64),
            "b": np.concatenate([zero, ids[root[moved]]]).astype(np.int64),
            "n": np.concatenate([counts[some], np.zeros(len(moved))]).astype(np.int64),
        }
    )


def graph_edges(members: DataFrame) -> DataFrame:
    """Pairs of node and neighbour of the shards' graphs."""
    import numpy as np
    import pyarrow as pa

    def build(table: pa.Table) -> pa.Table:
        ids, graph = table.column("id").to_numpy(), neighbours(unit(table.column("v")))
        node, slot = np.nonzero(graph >= 0)
        return pa.table({"node": ids[node], "neighbour": ids[graph[node, slot]]})

    return members.select("shard", "id", "v").groupBy("shard").applyInArrow(build, "node long, neighbour long")


def united(edges: DataFrame) -> DataFrame:
    """node and its neighbours over all shards of all runs; a link is walked both ways."""
    both = edges.unionByName(edges.select(F.col("neighbour").alias("node"), F.col("node").alias("neighbour")))
    return both.groupBy("node").agg(F.collect_set("neighbour").alias("next"))


def searched_shards(members: DataFrame, edges: DataFrame) -> DataFrame:
    """Links of every vector in its home shard, found on the united graph from the shard's medoid."""
    import numpy as np
    import pyarrow as pa

    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, home = table.column("id").to_numpy(), table.column("home").to_numpy()
        matrix, lists = unit(table.column("v")), table.column("next").to_pylist()
        rows = [np.asarray(x or [], np.int64) for x in lists]
        flat = np.concatenate(rows)
        owner = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
        at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1)
        here = ids[at] == flat
        owner, at = owner[here], at[here]
        width = np.bincount(owner, minlength=len(ids))
        graph = np.full((len(ids), max(int(width.max(initial=0)), 1)), -1, np.int64)
        graph[owner, np.arange(len(owner)) - np.repeat(np.cumsum(width) - width, width)] = at
        medoid = int((matrix @ matrix.mean(axis=0)).argmax())
        queries = np.flatnonzero(home)
        linked = np.zeros((len(ids), len(ids)), bool)
        linked[queries] = searched(matrix, graph, queries, medoid)
        return results(table, linked)

    rows = members.join(edges, members.id == edges.node, "left").select("shard", "home", "id", "v", "next", *MARKS)
    return rows.groupBy("shard").applyInArrow(search, RESULT)


def compared_blocks(members: DataFrame) -> DataFrame:
    """Links of the vectors of dense shards: every pair of blocks of a shard is one group."""
    import numpy as np
    import pyarrow as pa

    half = SHARD_ROWS // 2
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") / half).cast("int").alias("blocks"))
    rows = members.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        block, i, j = (table.column(c).to_numpy() for c in ("block", "i", "j"))
        matrix = unit(table.column("v"))
        linked = matrix @ matrix.T >= THRESHOLD
        linked &= (block[:, None] != block[None, :]) | (i[0] == j[0])
        np.fill_diagonal(linked, False)
        return results(table, linked)

    return rows.drop("blocks", "other").groupBy("shard", "i", "j").applyInArrow(compare, RESULT)


def audit(classes: DataFrame, counted: DataFrame) -> float | None:
    """The mean share of a vector's links that were found, over those of AUDITED vectors by hash that have links by brute
    force over all vectors; null if none has."""
    import numpy as np
    import pyarrow as pa

    asked = classes.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(AUDITED).collect()
    if not asked:
        return None
    by_size: dict[int, list] = {}
    for row in asked:
        by_size.setdefault(len(row["v"]), []).append(row)
    sent = shared(classes.sparkSession, {k: ([r["id"] for r in x], [r["v"] for r in x]) for k, x in by_size.items()})

    def compare(batches):
        questions = {k: (np.array(ids), unit(pa.array(v, pa.list_(pa.float64())))) for k, (ids, v) in sent().items()}
        for batch in batches:
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            for size, (ids, matrix) in questions.items():
                mine = batch.take(pa.array(np.flatnonzero(sizes == size)))
                if mine.num_rows:
                    near = (unit(mine.column(2)) @ matrix.T >= THRESHOLD) & (mine.column(0).to_numpy()[:, None] != ids[None, :])
                    n = near.T @ mine.column(1).to_numpy()
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64))], ["id", "n"])

    real = classes.select("id", "n", "v").mapInArrow(compare, "id long, n long").groupBy("id").agg(F.sum("n").alias("real"))
    found = F.coalesce("n_links", F.lit(0)) / F.col("real")
    return real.filter("real > 0").join(counted, "id", "left").agg(F.avg(found).alias("recall")).first()["recall"]


def partitioned(classes: DataFrame, run: int) -> DataFrame:
    """Members (shard, home, id, v) of overlapping shards of all classes, stored; `dense` marks shards to compare in blocks."""
    size = F.concat(F.lit("d"), F.size("v")).alias("shard")
    members = classes.select(size, F.lit(True).alias("home"), "id", "v")
    shards, spent = None, []
    for level in range(MOST_SPLITS + 1):
        done, dense, members = split(members, level, run, spent)
        for part, mark in ((done, False), (dense, True)):
            if part is not None:
                part = part.select("shard", "home", "id", "v", F.lit(mark).alias("dense"))
                shards = part if shards is None else shards.unionByName(part)
        if members is None:
            break
    shards = store(shards, "shards")
    discard(*spent)
    return shards


def marked(members: DataFrame, marks: DataFrame, run: int) -> DataFrame:
    """The marks with the home and all shards of one more run."""
    shard = F.xxhash64("shard", F.lit(run))
    own = members.select("id", "home", shard.alias("at")).groupBy("id")
    own = own.agg(F.max(F.when(F.col("home"), F.col("at"))).alias("at"), F.collect_list("at").alias("more"))
    homes, seen = F.concat("homes", F.array("at")).alias("homes"), F.concat("seen", "more").alias("seen")
    return marks.join(own, "id").select("id", "n", homes, seen)


def near_copies(vectors: DataFrame) -> DataFrame:
    """Every row of `vectors` (vec_id long, embedding array) with n_links, component_id, kept and recall.

    Vectors at a cosine of THRESHOLD or more, in double precision, are linked. Equal vectors form one class with a
    number of copies, and classes are searched; a vector's links count all copies of the linked classes and its own
    class's other copies. Vectors that are null, empty or zero or hold null or non-finite components link with nothing;
    vectors of different lengths do not link. component_id is the smallest vec_id reachable, itself included; kept
    tells whether it is the vector's own. Rows with a null vec_id are searched alike and are kept only if nothing they
    reach has an id. Repeated rows are copies of each other. Other columns are ignored.

    Independent partitionings into overlapping shards are built and searched, their adjacency lists united, until the
    audit finds TARGET of the links, MOST_RUNS at most. recall: what the last audit found; null if no audited vector has links.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = F.coalesce(F.col("v").isNotNull() & fine & F.exists(F.col("v"), lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long"), v.alias("v"))
    good = rows.filter(fine)
    classes = good.groupBy("v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
    classes = store(store(classes, "classes").withColumn("id", F.monotonically_increasing_id()), "classes")
    none = F.array().cast("array<long>")
    marks = classes.select("id", "n", none.alias("homes"), none.alias("seen"))
    edges = links = counts = None
    for run in range(MOST_RUNS):
        shards = partitioned(classes, run)
        marks = store(marked(shards, marks, run), "marks")
        more = store(graph_edges(shards.filter("NOT dense")), "graph")
        edges = more if edges is None else edges.unionByName(more)
        members = shards.join(marks, "id")
        found = searched_shards(members.filter("NOT dense"), united(edges))
        found = store(found.unionByName(compared_blocks(members.filter("dense").drop("dense"))), "links")
        discard(shards)
        count, edge = found.filter("kind = 'count'").select("a", "n"), found.filter("kind = 'edge'").select("a", "b")
        counts, links = (count, edge) if run == 0 else (counts.unionByName(count), links.unionByName(edge))
        counted = store(counts.groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n_links")), "counts")
        if run + 1 >= LEAST_RUNS:
            recall = audit(classes, counted)
            if recall is None or recall >= TARGET:
                break
    roots = components(links)
    root = F.coalesce("root", "id").alias("root")
    placed = classes.join(roots, classes.id == roots.node, "left").select("id", "v", "n", "first_id", root)
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    known = placed.join(least, "root").join(counted, "id", "left")
    known = known.select("v", (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = good.join(known, "v").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~fine).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.unionByName(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept"), F.lit(recall).cast("double").alias("recall"))
