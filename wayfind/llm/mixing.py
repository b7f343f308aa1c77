"""Mixing sources to target weights: min-cost flow over membership patterns, then seeded choice of whole documents.

Documents are aggregated by the set of sources that hold them. Tokens flow from patterns to the quotas
of their sources; the k-th copy of a pattern's documents costs k a token, so copies are taken only
where single ones run out. Which documents a pattern's flow takes is decided by a seeded hash.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfind.llm.common import SPACE, columns_of, connected_components, with_key
from wayfind.sources.scratch import materialise

#: Hash ranges in which documents are ranked, so that a hot source is ranked in parallel.
SLICES = 1024
#: Documents that fill what the seeded choice left of a quota.
FILLERS = 3


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with `place`, from 0 in the order of code points, null last: by ranges of the order, of which the counts alone meet in one task."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged, _ = materialise(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return ranged.withColumn("within", within).join(parts, "part").withColumn("place", F.col("within") + F.col("before")).drop("part", "within", "before")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, target from (source, source_size), one row per source.

    Sources ordered by code point, null last, weigh `weights`, repeating, and share `share` of all
    sizes. A target stops at `cap` times its source's size and the excess is shared anew by weight
    until none is above. Each round of that is one aggregation, of which two sums reach the driver;
    sources only ever join those at their cap, so the rounds end.
    """
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows, _ = materialise(_numbered(sizes).select("source", "source_size", weight.alias("w")), "weights")
    level, pool = float("-inf"), None
    while True:
        full = F.col("w") * F.lit(level) > cap * F.col("source_size")
        sums = rows.agg(F.sum("source_size").alias("all"), F.sum(F.when(full, F.col("source_size"))).alias("full"), F.sum(F.when(~full, F.col("w"))).alias("open")).first()
        pool = share * (sums["all"] or 0) if pool is None else pool
        if not sums["open"]:
            break
        after = (pool - cap * (sums["full"] or 0)) / sums["open"]
        if after <= level:
            break
        level = after
    return rows.select("source", "source_size", F.least(F.col("w") * F.lit(level), cap * F.col("source_size")).alias("target"))


def route(tokens: dict[tuple, int], quotas: dict, max_copies: int) -> dict[tuple, int]:
    """Tokens that each pattern gives in the flow of flows()."""
    given = dict.fromkeys(tokens, 0)
    for (p, _), n in flows(tokens, quotas, max_copies).items():
        given[p] += n
    return given


def flows(tokens: dict[tuple, int], quotas: dict, max_copies: int) -> dict[tuple[tuple, object], int]:
    """Tokens from each pattern (a tuple of sources) to each source in a minimum-cost maximum flow to the quotas.

    Successive cheapest paths: copies of the patterns open one after the other, so the k-th copy is
    used only once no path of cheaper copies reaches an open quota. Within one cost, flow is moved
    along breadth-first augmenting paths pattern - source - pattern - source.
    """
    given = dict.fromkeys(tokens, 0)
    flow: dict[tuple[tuple, object], int] = {}
    left = dict(quotas)
    members: dict[object, list[tuple]] = {s: [] for s in quotas}
    for p in tokens:
        for s in p:
            if s in members:
                members[s].append(p)
    for copy in range(1, max_copies + 1):
        for start in sorted(tokens, key=repr):
            while (room := copy * tokens[start] - given[start]) > 0:
                came: dict[object, tuple] = {}
                queue, end = deque([start]), None
                visited = {start}
                while queue and end is None:
                    p = queue.popleft()
                    for s in p:
                        if s in came or s not in left:
                            continue
                        came[s] = (p,)
                        if left[s] > 0:
                            end = s
                            break
                        for q in members[s]:  # a full quota can give back what another pattern sends to it
                            if q not in visited and flow.get((q, s), 0) > 0:
                                visited.add(q)
                                came[q] = (s,)
                                queue.append(q)
                if end is None:
                    break
                path, at = [], end
                while True:
                    p = came[at][0]
                    path.append((p, at))
                    if p == start:
                        break
                    back = came[p][0]
                    path.append((p, back))
                    at = back
                move = min([room, left[end], *(flow[path[k]] for k in range(1, len(path), 2))])
                for k, arc in enumerate(path):
                    flow[arc] = flow.get(arc, 0) + (move if k % 2 == 0 else -move)
                given[start] += move
                left[end] -= move
    return {arc: n for arc, n in flow.items() if n}


def _running(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """rows(slice, ...) with `upto`, the sum of value up to each row of its group: slices are summed first, so that no task ranks a whole group."""
    before = Window.partitionBy(group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES rows a group
    sliced = rows.groupBy(group, "slice").agg(F.sum(value).alias("in_slice")).select(group, "slice", F.coalesce(F.sum("in_slice").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy(group, "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("upto", F.sum(value).over(within)).join(sliced, [group, "slice"]).withColumn("upto", F.col("upto") + F.col("before")).drop("before")


def choose(documents: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """documents(key, id, pattern, size, tie) with `taken`: whole documents whose sizes come near wanted(pattern, tokens, flow).

    Each document is taken flow div tokens times, and the rest of the flow goes to documents in the
    order of a seeded hash as long as they fit. What is left of it then goes to the largest document
    that still fits, FILLERS times. The order is that of (hash of seed and id, id, size, tie, key), so
    rows that repeat an id are told apart, and those alike in all but key may stand for each other.
    """
    order = ["h", "id", "size", "tie", "key"]
    wanted, _ = materialise(wanted, "wanted")  # tables of known size: the documents aren't shuffled by a pattern that may hold a third of them
    rows = documents.join(wanted, "pattern").withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("flow") / F.col("tokens"))).otherwise(0))
    rows = rows.select("key", "id", "pattern", "size", "tie", "whole", (F.col("flow") - F.col("whole") * F.col("tokens")).alias("gap"), F.xxhash64(F.lit(seed), "id").alias("h"))
    rows = rows.withColumn("slice", F.shiftrightunsigned("h", 64 - SLICES.bit_length() + 1)).withColumn("s", F.when(F.col("size") <= F.col("gap"), F.col("size")).otherwise(0))
    rows = _running(rows, "pattern", order, "s").withColumn("more", (F.col("s") > 0) & (F.col("upto") <= F.col("gap")))
    rows, _ = materialise(rows.drop("s", "upto"), "mix")
    used = rows.groupBy("pattern").agg(F.sum(F.when(F.col("more"), F.col("size")).otherwise(0)).alias("used"), F.max("gap").alias("gap"))
    gaps, _ = materialise(used.select("pattern", (F.col("gap") - F.col("used")).alias("left")), "gaps")
    fillers = rows.limit(0).select("key", "pattern", "size")
    for _ in range(FILLERS):  # a row per pattern each time; the table of rows is only read
        spare = rows.filter("size > 0 and not more").join(gaps, "pattern").filter("size <= left").join(fillers.select("key"), "key", "left_anti")
        best, _ = materialise(spare.groupBy("pattern").agg(F.max(F.struct("size", "h", "id", "tie", "key")).alias("b")).select("b.key", "pattern", "b.size"), "fillers")
        fillers = fillers.unionByName(best)
        gaps = gaps.join(best.select("pattern", "size"), "pattern", "left").select("pattern", (F.col("left") - F.coalesce("size", F.lit(0))).alias("left"))
    filled, _ = materialise(fillers.select("key", F.lit(True).alias("filler")), "fillers")
    rows = rows.join(filled, "key", "left").withColumn("more", F.col("more") | F.coalesce("filler", F.lit(False))).drop("filler")
    return rows.withColumn("taken", (F.col("whole") + F.col("more").cast("long")) * F.col("size"))


def routed(sums: DataFrame, quotas: DataFrame, max_copies: int) -> DataFrame:
    """pattern, source, flow: the arcs of a minimum-cost maximum flow from sums(pattern, tokens) to quotas(source, quota).

    Sources that no pattern of several touches need no search: their pattern gives what it has, up to
    the quota. The others fall into groups that patterns connect, and a task routes each group by
    itself, so what meets there are the patterns of one group, not documents, and no number of groups
    is too many. Patterns without a wanted source have no arc.
    """
    quotas, _ = materialise(quotas, "quotas")
    several = sums.filter(F.size("pattern") > 1)
    ties, _ = materialise(several.select(F.col("pattern")[0].alias("u"), F.explode("pattern").alias("v")).distinct(), "ties")
    alone = sums.filter(F.size("pattern") == 1).withColumn("source", F.col("pattern")[0]).join(quotas, "source")
    if ties.isEmpty():
        return alone.select("pattern", "source", F.least("quota", F.col("tokens") * max_copies).alias("flow"))
    groups, _ = materialise(connected_components(ties).select(F.col("node").alias("source"), "component"), "groups")
    members = sums.withColumn("source", F.explode("pattern")).join(groups, "source").join(quotas, "source", "left").select("component", "pattern", "tokens", "source", "quota")

    def run(own: pd.DataFrame) -> pd.DataFrame:
        tokens = {tuple(p): int(n) for p, n in zip(own["pattern"], own["tokens"], strict=True)}
        asked = own.dropna(subset="quota")
        found = flows(tokens, {s: int(q) for s, q in zip(asked["source"], asked["quota"], strict=True)}, max_copies)
        return pd.DataFrame([(list(p), s, n) for (p, s), n in found.items()], columns=["pattern", "source", "flow"])

    searched = members.groupBy("component").applyInPandas(run, "pattern array<string>, source string, flow bigint")
    return alone.join(groups.select("source"), "source", "left_anti").select("pattern", "source", F.least("quota", F.col("tokens") * max_copies).alias("flow")).unionByName(searched)


def _routed_choice(rows: DataFrame, quotas: DataFrame, max_copies: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """What choose() takes of rows(key, id, size, pattern, tie) by the flow to quotas(source, quota), and the arcs of that flow."""
    sums, _ = materialise(rows.groupBy("pattern").agg(F.sum("size").alias("tokens")), "patterns")
    arcs, _ = materialise(routed(sums, quotas, max_copies), "arcs")
    wanted = sums.join(arcs.groupBy("pattern").agg(F.sum("flow").alias("flow")), "pattern", "left").select("pattern", "tokens", F.coalesce("flow", F.lit(0)).alias("flow"))
    return choose(rows, wanted, seed), arcs


def _served(chosen: DataFrame, arcs: DataFrame) -> DataFrame:
    """key, id, size, pattern, taken, source of chosen documents: the source that each serves, along the arcs of its pattern; null where nothing is taken."""
    served = _running(chosen.select("key", "pattern", "slice", "h", "id", "size", "tie", "taken"), "pattern", ["h", "id", "size", "tie", "key"], "taken")
    ends = Window.partitionBy("pattern").orderBy("source").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # the sources of one pattern
    shares = arcs.withColumn("end", F.sum("flow").over(ends)).groupBy("pattern").agg(F.sort_array(F.collect_list(F.struct("end", "source"))).alias("shares"))
    served = served.join(shares, "pattern", "left")
    own = F.filter("shares", lambda x: x["end"] > F.col("upto") - F.col("taken"))
    return served.select("key", "id", "size", "pattern", "taken", F.when(F.col("taken") > 0, F.coalesce(F.get(own, F.lit(0)), F.element_at("shares", -1))["source"]).alias("source"))


def mix(documents: DataFrame, quotas: dict, seed: int = 42, max_copies: int = 2) -> DataFrame:
    """id, size, sources, taken, source from documents(id, size, sources): tokens that the mixture takes of each document, repeats counted, and the source they serve.

    quotas maps each source to its tokens. Taken is a multiple of the size, at most max_copies times;
    source is null where nothing is taken. Documents without tokens or without a wanted source are
    taken 0 times. The order of the sources in a row is irrelevant.
    """
    rows = documents.select("id", "size", F.sort_array(F.array_distinct("sources")).alias("pattern"))
    rows, _ = materialise(rows.withColumn("key", F.monotonically_increasing_id()).withColumn("tie", F.lit(0)), "members")
    asked = documents.sparkSession.createDataFrame([(s, int(q)) for s, q in quotas.items()], "source string, quota bigint")
    chosen, arcs = _routed_choice(rows, asked, max_copies, seed)
    return _served(chosen, arcs).select("id", "size", F.col("pattern").alias("sources"), "taken", "source")


def _named(source: Column) -> Column:
    """A name for each source, the null one too."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def _aims(rows: DataFrame, weights: tuple[int, ...], share: float, max_copies: int) -> DataFrame:
    """name, source, source_size, target of the sources of rows(size, source)."""
    aims = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, float(max_copies))
    return materialise(aims.withColumn("name", _named(F.col("source"))), "targets")[0]


def _mixed(rows: DataFrame, aims: DataFrame, max_copies: int, seed: int) -> DataFrame:
    """rows(key, id, size, source, tie) with source_size, target, taken; each document has the pattern of its one source."""
    quotas = aims.select(F.col("name").alias("source"), F.least(F.round("target").cast("long"), F.col("source_size") * max_copies).alias("quota"))
    chosen, _ = _routed_choice(rows.withColumn("pattern", F.array(_named(F.col("source")))), quotas, max_copies, seed)
    return chosen.withColumn("name", F.col("pattern")[0]).join(aims, "name")


def _shared(rows: DataFrame, aims: DataFrame, max_copies: int, seed: int) -> DataFrame:
    """key, sources, mix_taken, mix_source of rows(key, id, size, source, tie, content): the mixture of different texts, each held by all sources that have a row of it.

    Of the rows of a text the one of smallest id, null last, then key, stands for it; the others have 0.
    """
    first = F.struct(F.col("id").isNull(), "id", "key")
    texts = rows.groupBy("content").agg(F.min_by(F.struct("key", "id", "size", "tie"), first).alias("r"), F.sort_array(F.collect_set(_named(F.col("source")))).alias("pattern"))  # as many names as there are sources
    texts, _ = materialise(texts.select("r.*", "pattern", "content"), "texts")
    quotas = aims.select(F.col("name").alias("source"), F.round("target").cast("long").alias("quota"))
    chosen, arcs = _routed_choice(texts.drop("content"), quotas, max_copies, seed)
    plain = lambda n: F.when(n != "0", F.substring(n, F.lit(2), F.char_length(n)))
    names = F.concat(F.transform(F.filter("pattern", lambda n: n != "0"), plain), F.transform(F.filter("pattern", lambda n: n == "0"), plain))
    taken, _ = materialise(_served(chosen, arcs).select(F.col("key").alias("of"), "taken", "source"), "shared")
    held, _ = materialise(texts.select("content", "key", names.alias("sources")).join(taken, F.col("key") == taken["of"]).select("content", F.col("key").alias("of"), "sources", "taken", "source"), "held")
    own = rows.select("key", "content").join(held, "content")
    mine = F.col("key") == F.col("of")
    name = plain(F.col("source"))
    return own.select("key", "sources", F.when(mine, F.col("taken")).otherwise(0).alias("mix_taken"), F.when(mine, name).alias("mix_source"))


def _measured(keyed: DataFrame, id_col: str, text_col: str, source_col: str, content: bool = False) -> DataFrame:
    text = F.coalesce(F.col("d").getField(text_col), F.lit(""))
    rows = keyed.select("key", F.col("d").getField(id_col).alias("id"), word_count(text).alias("size"), F.col("d").getField(source_col).alias("source"), F.xxhash64(text).alias("tie"), *([F.unhex(F.sha2(F.translate(text, SPACE, ""), 256)).alias("content")] if content else []))
    return materialise(rows, "sizes")[0]


def mix_by_source(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_copies: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken of docs(doc_id, text, source), each row of one source, and of the mixture of its different texts sources, mix_taken, mix_source.

    taken is of the mixture in which every row belongs to its own source. In the other one rows of the
    same text, white space aside, are one document that all their sources hold; `sources` are those,
    null last, mix_taken what it takes of the text, told on the row of smallest id, and mix_source the
    source that it serves. Both go for the same targets, by the same flow.

    Null text has size 0, null source is a source of its own, an empty table gives no rows. Rows that
    repeat an id, null ids among them, are chosen each by itself. Reruns agree: the choice depends on
    seed, ids, sizes and texts alone. Other columns are ignored.
    """
    rows = _measured(with_key(docs), id_col, text_col, source_col, content=True)
    aims = _aims(rows, weights, share, max_copies)
    mixed = _mixed(rows, aims, max_copies, seed).select("key", F.col("id").alias("doc_id"), "size", "source", "source_size", "target", "taken")
    return mixed.join(_shared(rows, aims, max_copies, seed), "key").drop("key")


def take_by_source(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, max_copies: int = 2, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as often as mix_by_source takes them, with the columns of docs."""
    keyed = with_key(docs)
    rows = _measured(keyed, id_col, text_col, source_col)
    mixed = _mixed(rows, _aims(rows, weights, share, max_copies), max_copies, seed)
    times, _ = materialise(mixed.filter("taken > 0").select("key.f", "key.r", (F.col("taken") / F.col("size")).cast("int").alias("times")), "times")
    taken = keyed.select("d", "key.f", "key.r").join(times.hint("merge"), ["f", "r"]).withColumn("copy", F.explode(F.sequence(F.lit(1), "times")))
    return columns_of(taken, docs.columns)


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs as often as mixed(doc_id, size, taken) takes their id, with the columns of docs; rows that share an id are taken alike."""
    times = mixed.filter("taken > 0").groupBy("doc_id").agg(F.max(F.col("taken") / F.col("size")).cast("int").alias("times"))
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("d"))
    joined = whole.join(times, F.col("d").getField(id_col).eqNullSafe(times["doc_id"]))
    return columns_of(joined.withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))), docs.columns)
