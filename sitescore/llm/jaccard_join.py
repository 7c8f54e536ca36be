"""N-gram Jaccard join by parity sketches.

The shingles of a set are dealt over cells by their hash, and each cell holds the
XOR of its shingles' 64-bit hashes. Two sets differ in at most as many cells as
their symmetric difference has shingles. Sets that reach the similarity differ
in at most d shingles, where d follows from the band of their sizes, so with
d + 1 + e cells at least e + 1 cells agree. Sets of compatible bands are joined
on their cells; what they share is verified on the whole sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitescore.llm.components import components
from sitescore.llm.kit import MIX1, MIX2, ROLL, U64, Scratch, Words, chunked, copied_texts, exchange_keys, first_places, kept, mix, read_chunk, rolled, row_key, split_by_keys, word64

FOUND = "kind int, doc_id long, row long, n long, node long, key long, part int, need int, most_apart int, tokens binary"
#: A set sends the cells it compares with its own band, with the next larger one and with the next smaller one.
SAME, UP, DOWN = 0, 1, 2
DOCUMENT, MEMBER, SET = 0, 1, 2


def bands(largest: int, percent: int) -> np.ndarray:
    """Lower ends of the size bands; sets that can link lie in the same or neighbouring bands."""
    low = [1, 2]
    while low[-1] <= largest + 1:
        low.append(max(low[-1] + 1, (low[-1] - 1) * 100 // percent + 1))
    return np.array(low + [max(low[-1] + 1, (low[-1] - 1) * 100 // percent + 1)], np.int64)


def cells(low: np.ndarray, band: np.ndarray, cross: bool, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pairs of a band with itself (or the next one): d, slack e and the number of cells."""
    top = low[band + 1] - 1
    other = np.minimum(low[band + 2] - 1, top * 100 // percent) if cross else top
    d = (100 - percent) * (top + other) // (100 + percent)
    e = 3 + (d + 1) * 12 // 100
    return d, e, d + 1 + e


def shingle_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each text's different shingles, sorted, end to end; where each text begins; its set's name.

    A text of fewer than ``width`` words has its whole sequence as one shingle.
    """
    words = Words(texts, lower=True)
    hashes = words.hashes()
    all_rolled = rolled(hashes, width)
    sets = []
    for d in range(len(texts)):
        s, e = int(words.first[d]), int(words.first[d + 1])
        if e - s >= width:
            sets.append(np.unique(all_rolled[s : e - width + 1]))
        elif e > s:
            sets.append(mix(rolled(hashes[s:e], e - s) + word64((e - s) * int(MIX1))))
        else:
            sets.append(np.zeros(0, U64))
    first = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int64)
    tokens = np.concatenate(sets) if sets else np.zeros(0, U64)
    total = np.concatenate(([U64(0)], np.cumsum(mix(tokens ^ MIX2), dtype=U64)))
    size = np.diff(first).astype(U64)
    return tokens, first, mix((total[first[1:]] - total[first[:-1]]) ^ (size * ROLL))


def _emit(tokens: np.ndarray, first: np.ndarray, band: np.ndarray, low: np.ndarray, cross: bool, percent: int):
    """Keys of the cells of some sets for one kind of band pair.

    Returns the set and the key of each cell, and for each set how many must
    agree and the most shingles in which a linked pair differs; the latter is
    -1 for a set whose single cell in common need not grow for smaller partners.

    Every cell that holds a shingle is sent. At least e + 1 cells of a linked
    pair agree, of which no more can be empty than either set has empty ones, so
    e + 1 less those must be found. A set with more empty cells than the slack
    also sends its d + 1 first shingles, of which two sets in reach share one.
    """
    d, e, count = cells(low, band, cross, percent)
    use = d > 0
    size = np.where(use, np.diff(first), 0)
    owner = np.repeat(np.arange(len(size)), size)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
    mine = tokens[np.repeat(first[:-1], size) + inside]
    cell = ((mine >> U64(32)) * count[owner].astype(U64)) >> U64(32)
    if not len(mine):
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(len(size), np.int64), np.full(len(size), -1)
    fresh = np.ones(len(mine), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (cell[1:] != cell[:-1])
    begin = np.flatnonzero(fresh)
    whose = owner[begin]
    kind = mix((band[whose] * 2 + cross).astype(U64) * MIX1 + cell[begin])
    keys = mix(np.bitwise_xor.reduceat(mix(mine ^ ROLL), begin) ^ kind)
    empty = count - np.bincount(whose, minlength=len(size))
    scarce = use & (empty > e)
    if scarce.any():
        early = scarce[owner] & (inside <= d[owner])
        whose = np.concatenate((whose, owner[early]))
        keys = np.concatenate((keys, mix(mine[early] ^ mix((band[owner[early]] * 2 + cross).astype(U64) * MIX2))))
    return whose, keys, np.where(scarce, 1, e + 1 - empty), np.where(scarce, -1, d)


def sketch(docs: DataFrame, width: int, percent: int, chunk_bytes: int) -> DataFrame:
    """Rows of three kinds: documents, sets in cells that other sets share, and the shingles of those sets."""

    chunks = chunked(docs, chunk_bytes)

    def keys_of(rows: pa.Table, copies: list[bytes]):
        ids, row, texts = read_chunk(rows)
        tokens, first, names = shingle_sets(texts, width)
        size = np.diff(first)
        low = bands(int(size.max(initial=1)), percent)
        # one set of each name, in the order of the documents; copies of a text elsewhere send nothing
        own = np.flatnonzero((np.frombuffer(copies[0], np.uint8) == 0) & (size > 0))
        one = own[first_places(names[own])[0]]
        begin = first[one]
        starts = np.concatenate(([0], np.cumsum(size[one])))
        pick = np.repeat(begin, size[one]) + np.arange(starts[-1]) - np.repeat(starts[:-1], size[one])
        tokens = tokens[pick]
        band = np.searchsorted(low, size[one], "right") - 1
        whose, keys, part, need, apart = [], [], [], [], []
        for number, (shift, cross) in ((SAME, (0, False)), (UP, (0, True)), (DOWN, (-1, True))):
            lower = band + shift
            ok = np.where(lower >= 0, lower, 0)
            w, k, n, m = _emit(tokens, starts, ok, low, cross, percent)
            good = lower[w] >= 0
            whose.append(w[good])
            keys.append(k[good])
            part.append(np.full(int(good.sum()), number))
            need.append(n)
            apart.append(m)
        whose, keys, part = np.concatenate(whose), np.concatenate(keys), np.concatenate(part)
        place, counts = first_places(keys)
        return keys[place], counts, (ids, row, size, names, one, tokens, starts, whose, keys, part, np.array(need), np.array(apart), place)

    def finish(state, flags: np.ndarray) -> pa.Table:
        ids, row, size, names, one, tokens, starts, whose, keys, part, need, apart, place = state
        order = np.argsort(keys[place])
        shared = flags[order[np.searchsorted(keys[place][order], keys)]] > 0 if len(keys) else np.zeros(0, bool)
        need = np.maximum(1, need.T.reshape(-1, 3))
        apart = apart.T.reshape(-1, 3)
        agree = np.bincount(whose[shared] * 3 + part[shared], minlength=3 * len(one)).reshape(-1, 3)
        enough = agree >= need
        member = shared & enough[whose, part]
        held = np.unique(whose[member])
        names = names.view(np.int64)
        n_doc, n_mem, n_set = len(ids), int(member.sum()), len(held)
        none = lambda n: [None] * n
        blank = pa.nulls(n_doc + n_mem, pa.binary())
        sets = pa.array([tokens[starts[i] : starts[i + 1]].tobytes() for i in held], pa.binary())
        return pa.table(
            {
                "kind": pa.array(np.repeat([DOCUMENT, MEMBER, SET], [n_doc, n_mem, n_set]), pa.int32()),
                "doc_id": pa.concat_arrays([pa.array(ids, pa.int64()), pa.nulls(n_mem + n_set, pa.int64())]),
                "row": pa.array(row + none(n_mem + n_set), pa.int64()),
                "n": pa.array(np.concatenate((size, size[one][whose[member]], size[one][held])), pa.int64()),
                "node": pa.array(np.concatenate((names, names[one][whose[member]], names[one][held])), pa.int64()),
                "key": pa.concat_arrays([pa.nulls(n_doc, pa.int64()), pa.array(keys[member].view(np.int64)), pa.nulls(n_set, pa.int64())]),
                "part": pa.concat_arrays([pa.nulls(n_doc, pa.int32()), pa.array(part[member], pa.int32()), pa.nulls(n_set, pa.int32())]),
                "need": pa.concat_arrays([pa.nulls(n_doc, pa.int32()), pa.array(need[whose[member], part[member]], pa.int32()), pa.nulls(n_set, pa.int32())]),
                "most_apart": pa.concat_arrays([pa.nulls(n_doc, pa.int32()), pa.array(apart[whose[member], part[member]], pa.int32()), pa.nulls(n_set, pa.int32())]),
                "tokens": pa.concat_arrays([blank, sets]),
            }
        )

    return exchange_keys(chunks, keys_of, finish, FOUND, hot=1 << 62, aside=copied_texts(chunks))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int, group: int = 512) -> DataFrame:
    """The (a, b) pairs that reach the similarity. Sets with very many partners are split over tasks."""
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / group).cast("int").alias("parts"))
    pairs = pairs.join(many, "a").withColumn("part", F.pmod(F.hash("b"), F.col("parts")))
    right = pairs.join(sets.select(F.col("node").alias("b"), "tokens"), "b").select("a", "part", "b", "tokens")
    left = many.join(sets.select(F.col("node").alias("a"), "tokens"), "a")
    left = left.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("b"), "tokens")
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = left.unionAll(right).withColumn("bin", F.pmod(F.xxhash64("a", "part"), F.lit(4 * tasks)))

    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("a", "ascending"), ("part", "ascending"), ("b", "ascending")])
        a, part, b = (table[c].to_pylist() for c in ("a", "part", "b"))
        tokens = table["tokens"].combine_chunks()
        base = {}
        for i, other in enumerate(b):
            if other is None:
                base[a[i], part[i]] = np.frombuffer(tokens[i].as_py(), U64)
        links = []
        for i, other in enumerate(b):
            if other is not None:
                x, y = base[a[i], part[i]], np.frombuffer(tokens[i].as_py(), U64)
                both = np.concatenate((x, y))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    links.append((a[i], other))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return rows.groupBy("bin").applyInArrow(verify, "a long, b long")


def _fits(percent: int):
    """Sizes that allow the similarity at all."""
    return F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent


def _need(percent: int):
    """How many cells a linked pair must share, by its own sizes.

    A set's need follows from the largest sizes of its band. A pair of smaller
    sets differs in fewer shingles, and in that many fewer cells. Sets that need
    only one cell (those with many empty cells) stay at one.
    """
    difference = F.floor((100 - percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    tighter = lambda side: F.when(F.col(f"most_{side}") < 0, F.col(f"need_{side}")).otherwise(F.col(f"need_{side}") + F.col(f"most_{side}") - difference)
    return F.greatest(F.lit(1), tighter("a"), tighter("b"))


def _common(one: list[np.ndarray], two: list[np.ndarray] | None) -> np.ndarray:
    """How many values each set of ``one`` shares with each of ``two`` (None: with each of ``one`` itself).

    Only values that can be common to a pair take part, as products of 0/1
    matrices for 4096 of them at a time.
    """
    x = np.concatenate(one)
    if two is None:
        values, counts = np.unique(x, return_counts=True)
        shared = values[counts > 1]
    else:
        shared = np.intersect1d(x, np.concatenate(two))

    def placed(sets: list[np.ndarray]):
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(t) for t in sets])
        at = np.searchsorted(shared, tokens)
        held = np.flatnonzero(at < len(shared))
        held = held[shared[at[held]] == tokens[held]]
        held = held[np.argsort(at[held], kind="stable")]
        return len(sets), at[held], owner[held]

    left = placed(one)
    right = left if two is None else placed(two)
    common = np.zeros((left[0], right[0]), np.int64)
    for begin in range(0, len(shared), 4096):
        width = min(4096, len(shared) - begin)

        def matrix(rows, at, owner):
            lo, hi = np.searchsorted(at, [begin, begin + width])
            out = np.zeros((rows, width), np.float32)
            out[owner[lo:hi], at[lo:hi] - begin] = 1
            return out

        a = matrix(*left)
        common += (a @ (a if two is None else matrix(*right)).T).astype(np.int64)
    return common


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of a 0/1 matrix that join what all its pairs join, at most one for each row and column."""
    out, seen = [], (np.zeros(near.shape[0], bool), np.zeros(near.shape[1], bool))
    for start in np.flatnonzero(near.any(axis=1)):
        if seen[0][start]:
            continue
        seen[0][start] = True
        waiting = [(0, int(start))]
        while waiting:
            side, i = waiting.pop()
            reach = np.flatnonzero((near[:, i] if side else near[i]) & ~seen[1 - side])
            seen[1 - side][reach] = True
            waiting.extend((1 - side, int(j)) for j in reach)
            out.extend((int(j), i) if side else (i, int(j)) for j in reach)
    return out


def _joined_in_blocks(rows: DataFrame, content: DataFrame, on: list[str], accept, block: int, block_values: int, scratch: Scratch) -> DataFrame:
    """(a, b) pairs of nodes that join all that the accepted pairs inside each ``key`` join.

    ``rows`` has key, the columns ``on``, component and size. The rows of a key
    are dealt over blocks of about ``block`` rows or ``block_values`` values,
    whichever are more blocks. Each pair of blocks meets in one task with the
    ``content`` of its rows, so pairs are never rows. ``accept`` takes the table
    of a task, the sets of values there and the places of both blocks, the
    second None if they are one, and gives a 0/1 matrix; pairs inside a
    component do not count. A task returns the pairs of a spanning forest, so
    the result grows with the rows that meet.
    """
    blocks = F.ceil(F.greatest(F.count("*") / block, F.sum("size") / block_values)).cast("int").alias("blocks")
    keys = rows.groupBy("key").agg(blocks, (F.max("component") > F.min("component")).alias("open")).where("open").drop("open")
    rows = rows.join(keys, "key").withColumn("mine", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")).cast("int"))
    rows = scratch.keep(rows, "dealt")
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bins = max(4 * tasks, (rows.agg(F.sum(F.col("size") * F.col("blocks"))).first()[0] or 0) >> 20)
    dealt = rows.select("key", *on, "component", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumns({"lo": F.least("mine", "other"), "hi": F.greatest("mine", "other")}).drop("other")
    dealt = dealt.join(content, on).withColumn("bin", F.pmod(F.xxhash64("key", "lo", "hi"), F.lit(bins)))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("lo", "ascending"), ("hi", "ascending"), ("node", "ascending")])
        key, lo, hi, mine, node, component = (table[c].to_numpy() for c in ("key", "lo", "hi", "mine", "node", "component"))
        held = table["held"]
        if pa.types.is_binary(held.type):
            sets = [np.frombuffer(t.as_buffer(), U64) for c in held.chunks for t in c]
        else:
            sets = [t.values.to_numpy() for c in held.chunks for t in c]
        columns = {c: table[c].to_numpy() for c in table.column_names if c != "held"}
        fresh = np.flatnonzero((key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
        links = set()
        for s, e in zip([0, *fresh.tolist()], [*fresh.tolist(), len(key)]):
            alone = lo[s] == hi[s]
            one = np.arange(s, e) if alone else s + np.flatnonzero(mine[s:e] == lo[s])
            two = one if alone else s + np.flatnonzero(mine[s:e] == hi[s])
            if not len(one) or not len(two) or component[s:e].min() == component[s:e].max():
                continue
            common = _common([sets[i] for i in one], None if alone else [sets[i] for i in two])
            near = accept({c: v[one][:, None] for c, v in columns.items()}, {c: v[two][None, :] for c, v in columns.items()}, common)
            near &= component[one][:, None] != component[two][None, :]
            links.update((int(min(node[one[i]], node[two[j]])), int(max(node[one[i]], node[two[j]]))) for i, j in _forest(near))
        links = sorted(links)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("bin").applyInArrow(compare, "a long, b long").distinct()


def _joining_links(labelled: DataFrame, sets: DataFrame, percent: int, scratch: Scratch, block: int = 1024, block_values: int = 1 << 19) -> DataFrame:
    """(a, b) links between the components of the open cells, enough of them to join all that links join.

    The open cells of a set are put in one order for all sets, those with few
    members first. Two sets with t cells in common share one that is among the
    first m - t + 1 of the m cells of either, so only in those cells do sets
    meet. There they bring the names of all their cells (32 bits of each; where
    two of a set coincide, its need is lowered) and are candidates if as many
    agree as both need. What candidates join is a cluster, and the whole sets
    of a cluster meet and are compared.
    """
    own = labelled.groupBy("node", "part").agg(F.sort_array(F.collect_set(F.struct("held", "key"))).alias("cells"), *(F.first(c).alias(c) for c in ("need", "n", "component", "most_apart")))
    own = own.where(F.size("cells") >= F.col("need"))
    own = scratch.keep(own.withColumn("held", F.array_distinct(F.transform("cells", lambda c: F.shiftright(c["key"], 32).cast("int")))), "cells")
    early = F.slice("cells", 1, F.greatest(F.lit(0), F.size("cells") - F.col("need") + 1))
    rows = own.select(F.explode(F.transform(early, lambda c: c["key"])).alias("key"), "node", "part", "component", F.size("held").alias("size"))
    need = (F.col("need") - F.size("cells") + F.size("held")).alias("need")

    def candidate(a, b, common):
        difference = (100 - percent) * (a["n"] + b["n"]) // (100 + percent)
        tighter = lambda x: np.where(x["most_apart"] < 0, x["need"], x["need"] + x["most_apart"] - difference)
        fits = np.minimum(a["n"], b["n"]) * 100 >= np.maximum(a["n"], b["n"]) * percent
        kinds = (a["part"] == SAME) | (a["part"] != b["part"])
        return (common >= np.maximum(1, np.maximum(tighter(a), tighter(b)))) & fits & kinds

    def linked(a, b, common):
        return 100 * common >= percent * (a["n"] + b["n"] - common)

    met = _joined_in_blocks(rows, own.select("node", "part", "n", "most_apart", need, "held"), ["node", "part"], candidate, block, block_values, scratch)
    clusters = components(scratch.keep(met, "met")).withColumnRenamed("component", "key")
    rows = clusters.join(own.groupBy("node").agg(F.first("component").alias("component"), F.first("n").alias("size")), "node")
    rows = scratch.keep(rows, "clusters")
    content = sets.select("node", F.col("tokens").alias("held")).join(rows.select("node", F.col("size").alias("n")), "node")
    return _joined_in_blocks(rows, content, ["node"], linked, block, block_values, scratch)


def linked_sets(found: DataFrame, percent: int, star_rounds: int, few: float, scratch: Scratch) -> DataFrame:
    """(node, component) of the sets that link with another one.

    Sets of one band meet in the cells of that band, sets of neighbouring bands
    in those between the two. A pair is a candidate if as many cells agree as
    both sets need. Sets in one cell are not compared each with each. In a round, one set of
    each cell is drawn, and every set is compared with that drawn one with which
    it shares most cells, unless links join the two already. Cells whose sets
    are all joined are done. When the cells left hold at most ``few`` pairs for
    each of their members, when a round left more than half of the members, or
    after ``star_rounds`` rounds, the sets left meet
    block by block, so no link between components is missed. The table ``found`` is
    removed from ``scratch`` (as "sketch") once its cells and sets are written.
    """
    spark = found.sparkSession
    labelled = found.where(F.col("kind") == MEMBER).select("key", "part", "need", "most_apart", "node", "n", F.col("node").alias("component"))
    links = tested = spark.createDataFrame([], "a long, b long")
    comps, sets, turn = spark.createDataFrame([], "node long, component long"), None, 0
    former = None
    while True:
        drawn = F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"), F.col("part").alias("part_a"), F.col("need").alias("need_a"), F.col("most_apart").alias("most_a")))
        low, high, up = F.min("part"), F.max("part"), F.count_if(F.col("part") == UP)
        spread = (F.max("component") > F.min("component")) & ((high == SAME) | (low < high))
        count = F.count("*")
        most = F.when(high == SAME, count * (count - 1) / 2).otherwise(up * (count - up))
        cells_open = labelled.groupBy("key").agg(drawn.alias("s"), spread.alias("open"), count.alias("held"), most.alias("most")).where("open")
        cells_open = cells_open.select("key", "s.a", "s.n_a", "s.c_a", "s.part_a", "s.need_a", "s.most_a", "held", "most")
        labelled = scratch.keep(labelled.join(cells_open, "key"), "open")
        rest, members = labelled.where("node = a").agg(F.sum("most"), F.sum("held")).first()
        if rest is None:
            break
        if sets is None:
            sets = found.where(F.col("kind") == SET).join(labelled.select("node").distinct(), "node", "left_semi")
            sets = scratch.keep(sets.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")
            scratch.drop("sketch")
        last = rest <= few * members or turn >= star_rounds or (former is not None and 2 * members > former)
        former = members
        if last:
            fresh = scratch.keep(_joining_links(labelled, sets, percent, scratch), "fresh")
            if not fresh.isEmpty():
                comps = components(scratch.keep(links.unionAll(fresh), "links"))
            break
        two = labelled.select("key", "part", F.col("need").alias("need_b"), F.col("most_apart").alias("most_b"), F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"), "a", "n_a", "c_a", "part_a", "need_a", "most_a")
        pairs = two.where(F.col("c_a") != F.col("c_b")).where(_fits(percent)).where((F.col("part") == SAME) | (F.col("part") != F.col("part_a")))
        pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max(_need(percent)).alias("least")).where("shared >= least")
        seen = tested.unionAll(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pairs = pairs.join(seen, ["a", "b"], "left_anti").groupBy("b").agg(F.max(F.struct("shared", "a")).alias("s")).select("s.a", "b")
        pairs = scratch.keep(pairs, "pairs")
        if not pairs.isEmpty():
            fresh = scratch.keep(_verified(pairs, sets, percent), "fresh")
            if not fresh.isEmpty():
                links = scratch.keep(links.unionAll(fresh), "links")
                comps = components(links)
            tested = scratch.keep(tested.unionAll(pairs), "tested")
        labelled = labelled.select("key", "part", "need", "most_apart", "node", "n").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
        turn += 1
    scratch.drop("open", "cells", "dealt", "met", "clusters", "sets", "pairs", "fresh", "links", "tested", "sketch")
    return comps


def document_rows(found: DataFrame) -> DataFrame:
    return found.where(F.col("kind") == DOCUMENT).select("doc_id", "row", "n", "node")


def _documents(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """One row per document: doc_id, row, n, node, component and component_id, for the components of the sets.

    ``component`` names the component, also where ids are null or repeated; it is null without words.
    """
    least = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = least.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    scratch = Scratch(rows.sparkSession)
    least = scratch.keep(least, "classes")
    whole = scratch.keep(least.groupBy("component").agg(F.min("least").alias("whole")), "whole")
    least = scratch.keep(least.join(whole, "component").select("node", "component", F.col("whole").alias("least")), "classes")
    scratch.drop("whole")
    component_id = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return rows.join(least, "node", "left").withColumn("component", F.when(F.col("n") > 0, F.col("component"))).withColumn("component_id", component_id).drop("least")


def set_links(found: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """(a, b) of all pairs of different sets that link, a < b, whether other links join them or not.

    The sets of a cell are dealt over blocks of about ``block``, and each pair
    of blocks is a key of its own, so a cell of any size is spread over tasks.
    A pair is a candidate if as many cells agree as both sets need.
    """
    members = found.where(F.col("kind") == MEMBER).select("key", "part", "need", "node", "n").distinct()
    held = members.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("held")).where("held > 1")
    members = members.join(held.drop("held"), "key").withColumn("mine", F.pmod(F.xxhash64(F.lit(5), "node"), F.col("blocks")).cast("int"))
    members = kept(members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))), "members")
    names = (("node", "{}"), ("n", "n_{}"), ("part", "part_{}"), ("need", "need_{}"))
    one, two = (members.select("key", lo.alias("lo"), hi.alias("hi"), *(F.col(c).alias(x.format(side)) for c, x in names)) for side, lo, hi in (("a", F.col("mine"), F.col("other")), ("b", F.col("other"), F.col("mine"))))
    pairs = one.where("lo <= hi").join(two.where("lo <= hi"), ["key", "lo", "hi"])
    pairs = pairs.where("a <> b and (lo < hi or a < b)").where(_fits(percent)).where((F.col("part_a") == SAME) | (F.col("part_a") != F.col("part_b")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.greatest("need_a", "need_b").alias("need"))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("need").alias("least")).where("shared >= least")
    sets = found.where(F.col("kind") == SET).groupBy("node").agg(F.first("tokens").alias("tokens"))
    return kept(_verified(kept(pairs.select("a", "b"), "pairs"), kept(sets, "sets"), percent), "links")


def near_links(docs: DataFrame, width: int = 4, percent: int = 85, chunk_bytes: int = 2 << 20, block: int = 256) -> DataFrame:
    """The rows of :func:`near_copies` with n_links, the number of other documents that link with each.

    All links between different sets are found and verified, also inside a
    component, so time and space grow with the number of links between different
    sets. Documents with equal sets link and are only counted.
    """
    found = kept(sketch(docs, width, percent, chunk_bytes), "sketch")
    links = set_links(found, percent, block)
    classes = _documents(document_rows(found), components(links))
    held = classes.where("n > 0").groupBy("node").agg(F.count("*").alias("held"))
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    far = both.join(held.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.sum("held").alias("far"))
    number = held.join(far, held["node"] == far["a"], "left").select("node", (F.col("held") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    out = classes.join(number, "node", "left")
    n_links = F.when(F.col("n") > 0, F.col("n_links")).otherwise(0)
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), "component_id", n_links.alias("n_links"))


def _classes(docs: DataFrame, width: int, percent: int, chunk_bytes: int, star_rounds: int, few: float) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(sketch(docs, width, percent, chunk_bytes), "sketch")
    rows = scratch.keep(document_rows(found), "documents")
    return _documents(rows, linked_sets(found, percent, star_rounds, few, scratch))


def near_copies(docs: DataFrame, width: int = 4, percent: int = 85, chunk_bytes: int = 2 << 20, star_rounds: int = 6, few: float = 1.0) -> DataFrame:
    """One row per document: doc_id, row, n_shingles, component_id.

    A document's set holds the different shingles of ``width`` words of its
    lower-cased (A-Z) text, or its whole word sequence if it has fewer. Two
    documents link when 100 * intersection >= percent * union; ``component_id``
    is the smallest doc_id that links reach, the own one included. Documents
    with equal sets are one class and need no pairs. A null text is empty; a
    document without words links with nothing. A null id counts only where a
    component has no other.
    """
    out = _classes(docs, width, percent, chunk_bytes, star_rounds, few)
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, width: int = 4, percent: int = 85, chunk_bytes: int = 2 << 20, star_rounds: int = 6, few: float = 1.0) -> DataFrame:
    """``docs`` with one row of each component, all columns kept.

    The row with the smallest id stays, null only if there is no other, ties by
    the row key; of rows that repeat that id and text, one by its whole content.
    Rows without words link with nothing and stay.
    """
    rows = _classes(docs, width, percent, chunk_bytes, star_rounds, few).where("component is not null")
    rows = kept(rows.groupBy("component", "row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("held")), "rows")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"))
    best = rows.groupBy("component").agg(F.min(order).alias("best")).select("component", F.col("best.row").alias("best"))
    gone = kept(rows.join(best, "component").where("row <> best").select(F.col("row").alias("__row")), "gone")
    again = kept(rows.where("held > 1").join(best, "component").where("row = best").select(F.col("row").alias("__row")), "again")
    # whole texts of rows that surely stay are not shuffled
    some, others = split_by_keys(docs, row_key(), gone.unionAll(again))
    left = some.join(gone, row_key() == F.col("__row"), "left_anti")
    if again.isEmpty():
        return left.unionAll(others)
    content = F.xxhash64(F.to_json(F.struct(*docs.columns)))
    place = F.row_number().over(Window.partitionBy("__key").orderBy(content))
    keyed = left.withColumn("__key", row_key())
    single = keyed.join(again, F.col("__key") == F.col("__row"), "left_anti")
    repeats = keyed.join(again, F.col("__key") == F.col("__row"), "left_semi").withColumn("__place", place).where("__place = 1").drop("__place")
    return single.unionAll(repeats).drop("__key").unionAll(others)
