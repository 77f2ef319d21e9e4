"""Spelling variants: words one edit apart, found along a trie, and the form each leads to.

The trie of all words is a distributed table of edges. A state is (word, position, node,
edits): the word's first letters, up to the position, lead to the node with so many edits.
Level by level of the trie, states are joined with the edges that leave their nodes: states
without an edit take every edge and spend theirs (a replaced or an inserted letter; a deleted
one is an inserted one of the other word), states with an edit follow the letter they need.
A state that has used up its word at a node where a word ends, with one edit, is a pair.

The states before an edit need no join: they are the word's own prefixes. And a trie is wide
at its top and narrow below, so edits are only tried in the lower half: those in a word's
first half are found from its end, in the trie of the reversed words. Edges know which
letters follow them, so that states without a next step are not written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import join_spread, stored

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A word's form is so many times as frequent as the word.
TIMES = 10
#: Down to this depth a level of the trie is one letter. Below it levels grow by half, so that
#: the number of levels is logarithmic in the longest word; the edges that leave a node there
#: are as many as words that share so many letters and differ in the next few.
SINGLE_LEVELS = 24
#: Words below a node that one task takes, unless that makes for over ``_HOT_NODES`` salted nodes.
_NODE_WORDS = 1 << 10
_HOT_NODES = 10_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 1,
) -> DataFrame:
    """(id, run) for every maximal run of at least so many letters, A-Z in lower case."""
    text = F.translate(F.col(text_column), _UPPER, _LOWER)
    found = F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    return documents.select(F.col(id_column).alias("id"), F.explode(found).alias("run"))


def with_slips(found: DataFrame, every: int = 31) -> DataFrame:
    """The runs, one in ``every`` of them without one of its letters.

    Which run and which letter follows from the crc32 of ``id:run``; a null id is empty.
    """
    named = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    at = F.expr("cast(_h % length(run) as int)")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    hashed = found.withColumn("_h", F.crc32(named))
    return hashed.select("id", F.when(F.col("_h") % every == 0, slipped).otherwise(F.col("run")).alias("run"))


def vocabulary(
    found: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n): the different runs of enough letters that occur often enough."""
    long = found.where(F.length("run") >= least_length)
    counted = long.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def depths(longest: int, lowest: int = 0) -> list[int]:
    """Depths of the trie's levels from ``lowest`` on, up to the first beyond ``longest``."""
    found = [0]
    while found[-1] <= longest:
        last = found[-1]
        found.append(last + 1 if last < SINGLE_LEVELS else last + last // 2)
    return [d for d in found if d >= min(lowest, SINGLE_LEVELS)]


def _letter(at: Column) -> tuple[Column, Column]:
    """Bits for the letter at a position (from 0) of ``t``: for ASCII, and for others."""
    code = F.ascii(F.substring(F.col("t"), at + 1, F.lit(1)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), code % 64)
    none = F.lit(0).cast("long")
    return F.when(code.between(1, 127), bit).otherwise(none), F.when(code > 127, bit).otherwise(none)


def _seekers(words: DataFrame, levels: list[int]) -> DataFrame:
    """(side, t, size, n, start): each word from its front and, reversed, from its back.

    Edits behind the first half are looked for from the front, the others from the back.
    """
    half = F.ceil(F.length("word") / 2).cast("int")
    both = words.select(
        "n",
        F.length("word").alias("size"),
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("side"), F.col("word").alias("t"), half.alias("half")),
                F.struct(F.lit(1).alias("side"), F.reverse("word").alias("t"), (F.length("word") - half).alias("half")),
            )
        ),
    )
    start = F.array_max(F.filter(F.array(*map(F.lit, levels)), lambda d: d <= F.col("half")))
    return both.select("side", "t", "size", "n", start.alias("start"))


def _edges(seekers: DataFrame, levels: list[int]) -> DataFrame:
    """(at, side, child, n, ascii, other, below): the trie's edges, by the node they lead to.

    ``at`` is the depth of the node that they leave (-1 above the first level), ``n`` the
    count of the word that ends at the child, or null; ``ascii`` and ``other`` are the
    letters that follow, ``below`` the number of words there.
    """
    steps = [(-1, levels[0]), *zip(levels, levels[1:])]
    known = F.array(*(F.struct(F.lit(a).alias("at"), F.lit(b).alias("to")) for a, b in steps))
    size = F.col("size")
    path = seekers.select("side", "t", "size", "n", F.inline(F.filter(known, lambda s: s["at"] < size)))
    to = F.least("to", "size")
    letter = _letter(to)
    rows = path.select(
        "at", "side", F.expr("left(t, least(to, size))").alias("child"),
        F.when(to == size, F.col("n")).alias("n"), letter[0].alias("ascii"), letter[1].alias("other"),
    )
    return rows.groupBy("at", "side", "child").agg(
        F.max("n").alias("n"), F.bit_or("ascii").alias("ascii"), F.bit_or("other").alias("other"),
        F.count("*").alias("below"),
    )


_STATE = ["side", "t", "size", "n", "pos", "node", "near_n"]


def _arrived(reached: DataFrame) -> DataFrame:
    """States with one edit at ``child``: at a word's end, or with a next letter to follow.

    ``near_n`` is the count of the word that was found, or null if the state goes on.
    """
    after = _letter(F.col("pos"))
    follows = (F.col("ascii").bitwiseAND(after[0]) != 0) | (F.col("other").bitwiseAND(after[1]) != 0)
    ends = F.col("pos") == F.col("size")
    kept = reached.where(F.when(ends, F.col("end_n").isNotNull()).otherwise(follows))
    return kept.select(
        "side", "t", "size", "n", "pos", F.col("child").alias("node"), F.when(ends, F.col("end_n")).alias("near_n")
    )


def _edited(seekers: DataFrame, edges: DataFrame, hot: DataFrame, depth: int) -> DataFrame:
    """States after an edit on an edge that leaves the word's own prefix of ``depth`` letters."""
    own = seekers.where((F.col("start") <= depth) & (F.col("size") >= depth))
    own = own.withColumn("parent", F.expr(f"left(t, {depth})"))
    out = edges.withColumnRenamed("n", "end_n").withColumn("parent", F.expr(f"left(child, {depth})"))
    # at most _HOT_NODES nodes of a side
    few = F.broadcast(hot.where(F.length("child") == depth).select("side", F.col("child").alias("parent"), "salts"))
    own = own.join(few, ["side", "parent"], "left").withColumn(
        "salt", F.pmod(F.xxhash64("t"), F.coalesce("salts", F.lit(1))).cast("int")
    )
    out = out.join(few, ["side", "parent"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)).cast("int") - 1))
    )
    met = own.drop("salts").join(out.drop("salts"), ["side", "parent", "salt"])
    # a replaced letter uses up as many letters as the edge has, an inserted one one less
    length = F.length("child")
    tried = met.withColumn("pos", F.explode(F.array(length, length - 1))).where("pos <= size")
    label = F.expr(f"substring(child, {depth + 1})")
    taken = F.expr(f"substring(t, {depth + 1}, pos - {depth})")
    along = F.expr(f"substring(t, {depth + 1}, length(child) - {depth})")
    one = (length == depth + 1) | (F.levenshtein(label, taken, 1) == 1)
    # of two words of one length the smaller finds the other; an edge along the word itself is
    # no insertion yet, an equal one can be made further down
    tried = tried.where(one & F.when(F.col("pos") == length, label > taken).otherwise(label != along))
    return _arrived(tried)


def _followed(states: DataFrame, edges: DataFrame, step: int) -> DataFrame:
    """States with an edit that go on by the letters they need."""
    asked = states.withColumn("child", F.expr(f"concat(node, substring(t, pos + 1, {step}))"))
    met = asked.drop("near_n").join(edges.withColumnRenamed("n", "end_n"), ["side", "child"])
    return _arrived(met.withColumn("pos", F.least(F.col("pos") + step, F.col("size"))))


def neighbours(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(word, near, near_n): all ordered pairs that one letter inserted, deleted or replaced parts.

    ``words`` has (word, n) with different words of ``least_length`` letters or more.
    """
    longest = words.agg(F.max(F.length("word"))).first()[0]
    if longest is None:
        return words.select("word", F.col("word").alias("near"), F.col("n").alias("near_n"))
    levels = depths(longest, least_length // 2)
    seekers = stored(_seekers(words, levels), "seekers")
    ordered = _edges(seekers, levels).sortWithinPartitions("at")
    edges = stored(ordered, "edges")
    limit = max(_NODE_WORDS, seekers.count() // 2 // _HOT_NODES)
    salts = F.ceil(F.col("below") / limit).cast("int").alias("salts")
    hot = stored(edges.where(F.col("below") > limit).select("side", "child", salts), "hot-nodes")
    states, pairs = None, []
    for depth, after in zip(levels, levels[1:]):
        own = edges.where(F.col("at") == depth).drop("at", "below")
        met = _edited(seekers, own, hot, depth)
        if states is not None:
            going = states.where(F.col("near_n").isNull() & (F.length("node") == depth))
            met = met.unionByName(_followed(going, own, after - depth))
        states = stored(met.select(*_STATE), "states")
        pairs.append(states.where("near_n IS NOT NULL"))
    found = pairs[0]
    for more in pairs[1:]:
        found = found.union(more)
    front = lambda name: F.when(F.col("side") == 0, F.col(name)).otherwise(F.reverse(name))
    found = found.select(front("t").alias("a"), front("node").alias("b"), "n", "near_n")
    both = found.select(
        F.inline(
            F.array(
                F.struct(F.col("a").alias("word"), F.col("b").alias("near"), "near_n"),
                F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n").alias("near_n")),
            )
        )
    )
    # an insertion into a run of equal letters in the middle may be found from both ends
    return both.groupBy("word", "near").agg(F.max("near_n").alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where the forms lead in the end.

    A form is more frequent than its word, so there are no circles. Each round doubles the
    steps that a row has taken, and is stored.
    """
    known = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = known.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = join_spread(known, ahead, ["root"], F.xxhash64("word"), "left")
        known = stored(
            moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")),
            "roots",
        )
        if known.where("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(words: DataFrame, least_length: int = LEAST_LENGTH, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of (word, n).

    ``form`` is the near word with the largest count, of equal ones the first in code-point
    order, if that count is at least ``times`` the word's; else null. ``root`` is where forms
    lead from the word, the word itself if it has none. An empty table gives an empty result.
    """
    words = stored(words, "words")
    best = neighbours(words, least_length).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= times * F.col("n"), F.col("best")).alias("best"),
    )
    found = stored(
        found.select("word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")),
        "forms",
    )
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
