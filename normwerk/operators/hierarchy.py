"""Parent-child links to full hierarchies: path, depth, root, descendants and cycles.

1. *Components.* Links are first contracted inside batches of rows that came together (``_contract``: any grouping of the
   rows is right, one that keeps a document together contracts most). What is left, links between batches, is labelled by
   pointer doubling, a number of joins logarithmic in the longest chain of batches.
2. *Co-location.* Rows are placed by component, many components to a task.
3. *Traversal.* An iterative depth-first search with three node colours runs through each component; an edge back to an
   open node closes a cycle.

A component beyond ``max_component`` nodes never enters one task: its nodes are resolved by list ranking over the whole
cluster instead, with the same result. Each node then holds one pointer that doubles its reach each round, and sums; only
paths, where they are asked for, are as long as they are deep.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialize
from ..skew import salted_left_join

#: Links contracted together; bounds the memory of a contraction, not the result.
CONTRACT_ROWS = 200_000
#: Largest component that one task traverses.
MAX_COMPONENT = 100_000
#: Path entries after which the traversal hands over a batch.
EMIT_ENTRIES = 400_000

NODE_SCHEMA = "record_table string, node_id string, parent_id string, root_id string, depth int, path array<string>, n_descendants bigint, cycle_id string, on_cycle boolean"
_CONTRACTED = "record_table string, node_id string, parent_id string, top string, next string"


def latest_links(rows: DataFrame) -> DataFrame:
    """rows(record_table, node_id, parent_id, stamp, place) -> one link a node, that of the latest stamp.

    Of equal stamps the greatest parent counts; a null stamp is older than any. Null node ids are no nodes. A blank parent
    is none.
    """
    parent = F.when(F.trim("parent_id") != "", F.col("parent_id"))
    newest = F.max(F.struct(F.col("stamp"), parent.alias("parent_id"), F.col("place")))
    return (
        rows.where("node_id is not null")
        .groupBy("record_table", "node_id")
        .agg(newest.alias("l"))
        .select("record_table", "node_id", "l.parent_id", "l.place")
    )


def _contract_rows(tables: list[str], nodes: list[str], parents: list[str | None]) -> tuple[list[str], list[str | None]]:
    """For each node the last node that its links reach inside the batch, and that node's parent outside of it.

    A chain that ends in a cycle inside the batch has the cycle's smallest id as last node, and no parent outside.
    """
    parent = {(t, n): p for t, n, p in zip(tables, nodes, parents)}
    top: dict[tuple[str, str], tuple[str, str | None]] = {}
    for start in parent:
        walk, at, seen = [], start, {}
        while at in parent and at not in top and at not in seen:
            seen[at] = len(walk)
            walk.append(at)
            up = parent[at]
            if up is None:
                top[at] = (at[1], None)
                break
            at = (at[0], up)
        if at in top:
            end = top[at]
        elif at in seen:
            end = (min(n for _, n in walk[seen[at] :]), None)
        else:
            end = (walk[-1][1], at[1])
        for node in walk:
            top[node] = end
    ends = [top[(t, n)] for t, n in zip(tables, nodes)]
    return [e[0] for e in ends], [e[1] for e in ends]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        t, n, p = ([x for b in held for x in b.column(k).to_pylist()] for k in range(3))
        top, beyond = _contract_rows(t, n, p)
        s = pa.string()
        return pa.RecordBatch.from_arrays([pa.array(x, s) for x in (t, n, p, top, beyond)], ["record_table", "node_id", "parent_id", "top", "next"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= CONTRACT_ROWS:
            yield flush()
            held.clear()
    if held:
        yield flush()


def _label_open(contracted: DataFrame) -> DataFrame:
    """(record_table, top, component) of each batch end whose chain goes on in another batch.

    ``at`` runs along the contracted links in steps that double each round; ``least`` is the smallest id among the nodes
    stepped over. A chain that comes to an end is labelled by that end. One that doesn't, in more steps than there are
    links, is on or leads into a cycle; ``at`` is then on it, and another round from there sees all of the cycle.
    """
    open_ends = contracted.where("next is not null").select("record_table", "top", "next").distinct()
    known = contracted.select("record_table", F.col("node_id").alias("next"), F.col("top").alias("at"), F.col("next").alias("beyond"))
    links = materialize(
        open_ends.join(known, ["record_table", "next"], "left").select(
            "record_table", "top", F.coalesce("at", "top").alias("at"), (F.col("at").isNull() | F.col("beyond").isNull()).alias("ended"), F.col("top").alias("least")
        ),
        "links",
    )
    n_links = links.count()
    if n_links == 0:
        return links.select("record_table", "top", F.col("at").alias("component"))
    rounds = max(1, math.ceil(math.log2(n_links + 1))) + 1
    state, n_going = links, None
    for _ in range(rounds):
        step = state.select("record_table", F.col("top").alias("at"), F.col("at").alias("at2"), F.col("ended").alias("ended2"), F.col("least").alias("least2"))
        going = state.where("not ended")
        moved = going.join(step, ["record_table", "at"], "left").select(
            "record_table",
            "top",
            F.coalesce("at2", "at").alias("at"),
            F.coalesce("ended2", F.lit(True)).alias("ended"),
            F.least("least", F.coalesce("least2", "at")).alias("least"),
        )
        state = materialize(state.where("ended").unionByName(moved), "links")
        n_going = state.where("not ended").count()
        if n_going == 0:
            break
    if n_going:
        cycle = state.select("record_table", F.col("top").alias("at"), F.col("least").alias("component"))
        looping = state.where("not ended").join(cycle, ["record_table", "at"]).select("record_table", "top", "component")
        return state.where("ended").select("record_table", "top", F.col("at").alias("component")).unionByName(looping)
    return state.select("record_table", "top", F.col("at").alias("component"))


def components(links: DataFrame) -> DataFrame:
    """links(record_table, node_id, parent_id, place) -> (record_table, node_id, parent_id, component)."""
    together = links.select("record_table", "node_id", "parent_id", "place").hint("rebalance", F.col("place")).select("record_table", "node_id", "parent_id")
    contracted = materialize(together.mapInArrow(_contract, _CONTRACTED), "contracted")
    labels = _label_open(contracted)
    closed = contracted.where("next is null").select("record_table", "node_id", "parent_id", F.col("top").alias("component"))
    opened = contracted.where("next is not null").join(labels, ["record_table", "top"], "left")
    return closed.unionByName(opened.select("record_table", "node_id", "parent_id", F.coalesce("component", "top").alias("component")))


WHITE, GREY, BLACK = 0, 1, 2


def traverse(nodes: list[str], parents: list[str | None], paths: bool = True) -> Iterator[tuple]:
    """Rows of one component, without the table's name: an iterative depth-first search along the links to the children.

    Roots are searched first. Nodes still white afterwards never reach a root; the search from them follows the parents,
    and the first grey node it meets closes a cycle, whose nodes and everything below get the cycle's smallest id.
    """
    parent = dict(zip(nodes, parents))
    children: dict[str, list[str]] = {}
    for node, up in parent.items():
        if up in parent:
            children.setdefault(up, []).append(node)
    colour = dict.fromkeys(parent, WHITE)
    below = dict.fromkeys(parent, 0)

    for root in sorted(n for n, up in parent.items() if up not in parent):
        path, stack = [], [(root, False)]
        while stack:
            node, done = stack.pop()
            if done:
                colour[node] = BLACK
                path.pop()
                up = parent[node]
                if up in parent:
                    below[up] += below[node] + 1
                yield node, up, root, len(path), [*path, node] if paths else None, below[node], None, False
                continue
            colour[node] = GREY
            path.append(node)
            stack.append((node, True))
            stack.extend((child, False) for child in sorted(children.get(node, ()), reverse=True))

    cycle_of: dict[str, str] = {}
    rings: list[list[str]] = []
    for start in parent:
        walk, at = [], start
        while colour[at] == WHITE:
            colour[at] = GREY
            walk.append(at)
            at = parent[at]
        if colour[at] == GREY:  # a back edge
            ring = walk[walk.index(at) :]
            rings.append(ring)
            for node in ring:
                cycle_of[node] = min(ring)
        for node in reversed(walk):
            colour[node] = BLACK
            cycle_of.setdefault(node, cycle_of.get(parent[node], ""))
    on_ring = {node for ring in rings for node in ring}
    # below a cycle: leaves first, so that each node is counted once it is whole
    waiting = {node: sum(1 for c in children.get(node, ()) if c not in on_ring) for node in cycle_of}
    ready = [node for node, n in waiting.items() if n == 0 and node not in on_ring]
    while ready:
        node = ready.pop()
        up = parent[node]
        below[up] += below[node] + 1
        waiting[up] -= 1
        if waiting[up] == 0 and up not in on_ring:
            ready.append(up)
    for ring in rings:
        whole = sum(below[n] for n in ring) + len(ring) - 1
        for node in ring:
            below[node] = whole
    for node, cycle in cycle_of.items():
        yield node, parent[node], None, None, None, below[node], cycle, node in on_ring


def _traverse(paths: bool):
    """Over rows sorted by (record_table, component); a component may go over several batches."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string()] * 4 + [pa.int32(), pa.list_(pa.string()), pa.int64(), pa.string(), pa.bool_()]
        names = ["record_table", "node_id", "parent_id", "root_id", "depth", "path", "n_descendants", "cycle_id", "on_cycle"]
        out: list[tuple] = []
        entries = 0
        key, nodes, parents = None, [], []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

        def run() -> Iterator[pa.RecordBatch]:
            nonlocal entries, out
            for row in traverse(nodes, parents, paths) if nodes else ():
                out.append((key[0], *row))
                entries += 8 + len(row[4] or ())
                if entries >= EMIT_ENTRIES:
                    yield batch_of(out)
                    out, entries = [], 0

        for batch in batches:
            for t, c, n, p in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if (t, c) != key:
                    yield from run()
                    key, nodes, parents = (t, c), [], []
                nodes.append(n)
                parents.append(p)
        yield from run()
        if out:
            yield batch_of(out)

    return search


def _rank(links: DataFrame) -> DataFrame:
    """links(record_table, node_id, parent_id) -> (..., there, at, steps, ended, least, on_cycle) by list ranking.

    ``there``: the parent is among the nodes. ``at`` is the ancestor ``steps`` above, which doubles each round until it is
    the root (``ended``); ``least`` is the smallest id of those stepped over. What has not ended after more steps than there
    are nodes leads into a cycle: ``at`` is then on it, every node of it is the ``at`` of one, and ``least`` from there is the
    smallest of all of it.
    """
    known = links.select("record_table", F.col("node_id").alias("parent_id"), F.lit(True).alias("there"))
    first = links.join(known, ["record_table", "parent_id"], "left").withColumn("there", F.col("there").isNotNull())
    top = first.where("not there").select("record_table", F.col("node_id").alias("at"), F.lit(True).alias("ended"))
    state = first.withColumns({"at": F.when(F.col("there"), F.col("parent_id")).otherwise(F.col("node_id")), "steps": F.col("there").cast("bigint"), "least": F.col("node_id")})
    state = materialize(state.join(top, ["record_table", "at"], "left").withColumn("ended", F.col("ended").isNotNull()), "rank")
    rounds = max(1, math.ceil(math.log2(state.count() + 1))) + 1
    for _ in range(rounds):
        going = state.where("not ended")
        if going.isEmpty():
            break
        step = state.select("record_table", F.col("node_id").alias("at"), F.col("at").alias("at2"), F.col("steps").alias("steps2"), F.col("ended").alias("ended2"), F.col("least").alias("least2"))
        moved = salted_left_join(going, step, ["record_table", "at"], [F.col("node_id")], how="inner").select(
            "record_table", "node_id", "parent_id", "there", F.col("at2").alias("at"), (F.col("steps") + F.col("steps2")).alias("steps"), F.col("ended2").alias("ended"), F.least("least", "least2").alias("least")
        )
        state = materialize(state.where("ended").select(*moved.columns).unionByName(moved), "rank")
    ring = state.where("not ended").select("record_table", F.col("at").alias("node_id")).distinct().withColumn("on_cycle", F.lit(True))
    return materialize(state.join(ring, ["record_table", "node_id"], "left").withColumn("on_cycle", F.col("on_cycle").isNotNull()), "ranked")


def _below(ranked: DataFrame) -> DataFrame:
    """(record_table, node_id, n) of the trees that are left without the links between nodes of a cycle: n nodes below each.

    In round k each node holds how many are less than 2^k below it, and its ancestor 2^k above, to which that number is added.
    """
    up = F.when(F.col("there") & ~F.col("on_cycle"), F.col("parent_id"))
    state = materialize(ranked.select("record_table", "node_id", up.alias("up"), F.lit(1).cast("bigint").alias("n")), "below")
    while not state.where("up is not null").isEmpty():
        more = state.where("up is not null").groupBy("record_table", F.col("up").alias("node_id")).agg(F.sum("n").alias("m"))
        above = state.select("record_table", F.col("node_id").alias("up"), F.col("up").alias("up2"))
        going = salted_left_join(state.where("up is not null"), above, ["record_table", "up"], [F.col("node_id")]).select("record_table", "node_id", F.col("up2").alias("up"), "n")
        moved = state.where("up is null").select(*going.columns).unionByName(going).join(more, ["record_table", "node_id"], "left")
        state = materialize(moved.select("record_table", "node_id", "up", (F.col("n") + F.coalesce("m", F.lit(0))).alias("n")), "below")
    return state.select("record_table", "node_id", (F.col("n") - 1).alias("n"))


def _paths(ranked: DataFrame) -> DataFrame:
    """(record_table, node_id, path) of the nodes that reach a root; the ids above double each round."""
    none = F.array().cast("array<string>")
    up = F.when(F.col("there"), F.col("parent_id"))
    state = materialize(ranked.where("ended").select("record_table", "node_id", up.alias("up"), F.when(F.col("there"), F.array("parent_id")).otherwise(none).alias("trail")), "paths")
    while not state.where("up is not null").isEmpty():
        above = state.select("record_table", F.col("node_id").alias("up"), F.col("up").alias("up2"), F.col("trail").alias("trail2"))
        moved = salted_left_join(state.where("up is not null"), above, ["record_table", "up"], [F.col("node_id")], how="inner").select("record_table", "node_id", F.col("up2").alias("up"), F.concat("trail", "trail2").alias("trail"))
        state = materialize(state.where("up is null").select(*moved.columns).unionByName(moved), "paths")
    return state.select("record_table", "node_id", F.concat(F.reverse("trail"), F.array("node_id")).alias("path"))


def doubling(links: DataFrame, paths: bool = True) -> DataFrame:
    """The rows of ``traverse`` for links(record_table, node_id, parent_id), by joins alone: no bound on a component."""
    ranked = _rank(links)
    tree, key = F.col("ended"), ["record_table", "node_id"]
    ring = ranked.select("record_table", F.col("node_id").alias("at"), F.col("least").alias("ring_id"))
    looping = salted_left_join(ranked.where("not ended"), ring, ["record_table", "at"], [F.col("node_id")]).select(*key, F.col("ring_id").alias("cycle_id"))
    sizes = looping.groupBy("record_table", "cycle_id").agg((F.count(F.lit(1)) - 1).alias("others"))  # below each node of a cycle are all others
    whole = ranked.join(_below(ranked), key).join(looping, key, "left").join(sizes, ["record_table", "cycle_id"], "left")
    whole = whole.join(_paths(ranked), key, "left") if paths else whole.withColumn("path", F.lit(None).cast("array<string>"))
    return whole.select(
        *key, "parent_id", F.when(tree, F.col("at")).alias("root_id"), F.when(tree, F.col("steps").cast("int")).alias("depth"), "path",
        F.when(F.col("on_cycle"), F.col("others")).otherwise(F.col("n")).alias("n_descendants"), "cycle_id", "on_cycle",
    ).select(*[x.split(" ")[0] for x in NODE_SCHEMA.split(", ")])


def hierarchy(rows: DataFrame, max_component: int = MAX_COMPONENT, paths: bool = True) -> DataFrame:
    """rows(record_table, node_id, parent_id, stamp, place) -> one row a node, columns as NODE_SCHEMA.

    ``place`` only says which rows probably belong together (a document id); it doesn't change the result and may be null.
    A parent that doesn't exist ends the chain: its child is a root and keeps parent_id. Nodes on a cycle or leading into one
    have a cycle_id (the cycle's smallest id) and no root, depth or path. Repeated rows are one node; an empty input gives an
    empty result. Without ``paths`` all paths are null, which spares a chain of n nodes n * n / 2 ids.
    """
    placed = materialize(components(latest_links(rows)), "components")
    large = placed.groupBy("record_table", "component").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_component)
    large = materialize(large.drop("n"), "large")
    if large.isEmpty():
        small, rest = placed, None
    else:
        on = ["record_table", "component"]
        small, rest = placed.join(large, on, "left_anti"), placed.join(large, on, "left_semi")
    by_component = (
        small.select("record_table", "component", "node_id", "parent_id")
        .repartition("record_table", "component")
        .sortWithinPartitions("record_table", "component", "node_id")
    )
    result = by_component.mapInArrow(_traverse(paths), NODE_SCHEMA)
    if rest is not None:
        result = result.unionByName(doubling(rest.select("record_table", "node_id", "parent_id"), paths))
    return result


def descendants(nodes: DataFrame) -> DataFrame:
    """(record_table, ancestor_id, descendant_id, distance) of every tree of ``hierarchy``'s result, from the paths alone."""
    pairs = nodes.where("path is not null and depth > 0").select("record_table", "node_id", "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth"))).alias("at", "ancestor_id"))
    return pairs.select("record_table", "ancestor_id", F.col("node_id").alias("descendant_id"), (F.col("depth") - F.col("at")).alias("distance"))
