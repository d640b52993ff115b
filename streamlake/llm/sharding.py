"""Sharding by balanced label propagation, in DataFrame functions.

Documents start in evenly drawn shards. In each round the documents of a link group see
in which shard most of the group is, among those with room for it, and ask to move there. Requests between two shards are granted
in equal numbers both ways, and beyond that as far as the receiving shard has room beside
its linked documents; a lot drawn per group lets a group move as one. Rounds go on until no
request is left or the number of documents away from their group stops falling. A shard
then keeps the documents it was granted, up to its even count. Only the surplus over that,
and the documents without links, go where room is left.

Groups are hubs: a link (document, hub) stands for links to all documents of that hub, so
no pairs are made. A hub larger than a shard is taken as several of a shard's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlake.llm.files import staged
from streamlake.llm.numbering import numbered

ROUNDS = 16  # at most
PATIENCE = 4  # rounds without progress before the propagation ends
LARGE_HUBS = 256  # a hub with more than one link in so many is joined by broadcast; there are fewer than that
_DRAW = 1 << 20


def _lot(*columns: str | Column) -> Column:
    """A number from 0 to 1, drawn by the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(_DRAW)) / _DRAW


def _with_company(links: DataFrame, capacity: float) -> DataFrame:
    """Links whose hub has several nodes, as (node, hub, part); hubs over ``capacity`` in parts of it.

    Links of a large hub meet its size by broadcast, so no task gets a hub's links.
    """
    sizes = staged(links.groupBy("hub").agg(F.count(F.lit(1)).alias("_members")).filter("_members > 1"), "hubs")
    total = sizes.agg(F.sum("_members")).first()[0] or 0
    return _joined_by_hub(links, ["hub"], sizes, total).select(
        "node",
        "hub",
        F.floor(F.ceil(F.col("_members") / capacity) * _lot("node", F.lit("part"))).cast("long").alias("part"),
    )


def _joined_by_hub(links: DataFrame, by: list[str], hubs: DataFrame, total: int) -> DataFrame:
    """``links`` joined with one row per hub, which has its ``_members`` of ``total`` links."""
    large = F.broadcast(hubs.filter(F.col("_members") * LARGE_HUBS > total))  # less than LARGE_HUBS rows
    small = hubs.filter(F.col("_members") * LARGE_HUBS <= total)
    rest = links.join(large.select(*by), by, "left_anti")
    return links.join(large, by).unionByName(rest.join(small, by))


def _wishes(state: DataFrame, rooms: list[int]) -> DataFrame:
    """(node, shard, to, group): where a node's best represented hub should be as a whole.

    That is the shard that can hold most of the hub, by what it has of it and its room; the
    one with most of it between equals. The emptiest shard is one of the choices.
    """
    votes = state.groupBy("hub", "part", "shard").agg(F.count(F.lit(1)).alias("votes"))
    spread = votes.groupBy("hub", "part").agg(  # at most a shard's entry each
        F.collect_list(F.struct("votes", "shard")).alias("spread"), F.sum("votes").alias("_members")
    )
    emptiest = max(range(len(rooms)), key=rooms.__getitem__)

    def rank(shard: Column, votes: Column) -> Column:
        together = F.least(votes + _at(rooms, shard), F.col("_members"))
        return F.struct(together.alias("together"), votes.alias("votes"), (-shard).alias("first"))

    none = F.struct(F.lit(0).cast("long").alias("votes"), F.lit(emptiest).alias("shard"))
    choices = F.transform(F.concat("spread", F.array(none)), lambda x: rank(x["shard"], x["votes"]))
    top = staged(spread.select("hub", "part", "_members", F.array_max(choices).alias("top")), "tops")
    total = top.agg(F.sum("_members")).first()[0] or 0
    best = F.max(F.struct(F.col("top.votes"), F.col("top.first"), F.xxhash64("hub", "part").alias("group"))).alias("best")
    chosen = _joined_by_hub(state, ["hub", "part"], top, total).groupBy("node", "shard").agg(best)
    return chosen.select("node", "shard", (-F.col("best.first")).alias("to"), "best.group")


def _targets(total: int, shards: int) -> list[int]:
    """Even counts: the first shards have one more."""
    return [total // shards + (k < total % shards) for k in range(shards)]


def _at(values: list, shard: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), shard)


def _shares(flows: dict[tuple[int, int], int], rooms: list[int]) -> dict[tuple[int, int], float]:
    """The part of the requests between two shards that is granted: swaps, then room."""
    swapped = {(a, b): min(n, flows.get((b, a), 0)) for (a, b), n in flows.items()}
    rest = [0] * len(rooms)
    for (a, b), n in flows.items():
        rest[b] += n - swapped[a, b]
    return {(a, b): min(1.0, (swapped[a, b] + rooms[b] * (n - swapped[a, b]) / max(rest[b], 1)) / n) for (a, b), n in flows.items()}


def _counts(df: DataFrame, *by: str) -> dict:
    """Rows per shard, or pair of shards: at most their number squared."""
    return {tuple(r)[:-1] if len(by) > 1 else r[0]: r[-1] for r in df.groupBy(*by).agg(F.count(F.lit(1))).collect()}


def propagate(nodes: DataFrame, links: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(node, shard, group): the label of every linked node after the rounds, and its group.

    ``nodes`` has a unique ``node``, ``links`` has (node, hub). Nodes that share no hub are
    not in the result. Each round is a written table; the driver gets counts per pair of
    shards.
    """
    targets = _targets(nodes.count(), shards)
    drawn = F.floor(_lot("node") * shards).cast("int")
    company = staged(_with_company(links, max(1, targets[-1])), "links")
    state = company.withColumn("shard", drawn)
    best, fewest, patience = None, 0, PATIENCE
    for k in range(rounds + 1):
        sizes = _counts(state.select("node", "shard").distinct(), "shard")
        rooms = [max(0, t - sizes.get(s, 0)) for s, t in enumerate(targets)]
        wishes = staged(_wishes(state, rooms), "wishes")
        flows = {pair: n for pair, n in _counts(wishes, "shard", "to").items() if pair[0] != pair[1]}
        away = sum(flows.values())
        if best is None or away < fewest:
            best, fewest, patience = wishes, away, PATIENCE
        else:
            patience -= 1
        if not away or not patience or k == rounds:
            break
        shares = _shares(flows, rooms)
        table = [shares.get((a, b), 0.0) for a in range(shards) for b in range(shards)]
        granted = _lot("group", F.lit(k)) < _at(table, F.col("shard") * shards + F.col("to"))
        moved = wishes.select("node", F.when(granted, F.col("to")).otherwise(F.col("shard")).alias("shard"))
        state = staged(company.join(moved, "node"), "labels")
    return best.select("node", "shard", "group")


def even_shards(nodes: DataFrame, labels: DataFrame, shards: int) -> DataFrame:
    """(node, shard, slot): counts at most one apart, slots gapless from 0.

    A shard keeps its labelled nodes, group by group, up to its even count. The surplus
    fills the free slots first, the shards with most of them in front, and the nodes without
    a label the others.
    """
    rest = nodes.select("node").join(labels, "node", "left_anti").withColumns(
        {"shard": F.lit(shards), "group": F.xxhash64("node")}
    )
    placed, _ = numbered(labels.unionByName(rest), "shard", ["group", "node"])
    sizes = _counts(placed, "shard")
    targets = _targets(sum(sizes.values()), shards)
    held = [min(sizes.get(s, 0), t) for s, t in enumerate(targets)]
    surplus = [0]  # before each shard, and after the last
    for s, t in enumerate(targets):
        surplus.append(surplus[-1] + max(0, sizes.get(s, 0) - t))
    order = sorted(range(shards), key=lambda s: held[s] - targets[s])  # the most free slots first
    free = [0]  # before each shard of that order, and after the last
    for s in order:
        free.append(free[-1] + targets[s] - held[s])
    kept = F.col("pos") < _at([*targets, 0], F.col("shard"))
    # The place among the rows that look for room; those without a label come after all surplus.
    looking = _at(surplus, F.col("shard")) + F.col("pos") - _at([*targets, 0], F.col("shard"))
    turn = F.size(F.filter(F.array(*map(F.lit, free[1:])), lambda end: end <= looking))
    found = placed.withColumn("_turn", turn).withColumns(
        {
            "_into": F.when(kept, F.col("shard")).otherwise(_at(order, F.col("_turn"))),
            "slot": F.when(kept, F.col("pos")).otherwise(
                _at(held, _at(order, F.col("_turn"))) + looking - _at(free, F.col("_turn"))
            ),
        }
    )
    return found.select("node", F.col("_into").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def shard_documents(docs: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``(doc_id, text)``.

    Equal texts are linked; null texts are not. ``size`` is the length in UTF-8 bytes plus
    8, the checksum that of the UTF-8 text, null counting as empty. Shard counts are at
    most one apart. Repeated rows are documents of their own; other columns are ignored. Texts
    are read once and never shuffled.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    described = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))).alias("hub"),
    )
    nodes = staged(described.withColumn("node", F.monotonically_increasing_id()), "documents")
    links = nodes.filter(F.col("hub").isNotNull()).select("node", "hub")
    placed = even_shards(nodes, staged(propagate(nodes, links, shards, rounds), "labels"), shards)
    return nodes.drop("hub").join(placed, "node").drop("node")
