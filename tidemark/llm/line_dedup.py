"""Line deduplication by a deletion-neighbourhood join. DataFrame operations only.

Lines are compared as sequences of words, by edit distance over words. Lines of at least
``MIN_WORDS`` words that differ by one word inserted, deleted or replaced are near copies: four
fifths of the longer one's words or more are the same. Shorter lines must be equal. Of equal or
near lines the earliest one stays.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, nest, small, unnest
from tidemark.session import store

SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"
#: Of fewer words one edit leaves a similarity under 0.8.
MIN_WORDS = 5
#: Lines of more words get their keys from arrays in blocks, not from a row for each word that
#: holds all of the line.
LONG = 1000
BLOCK = 256


def _one_spaced(line: Column) -> Column:
    """The line's words with one space between them."""
    line = F.btrim(line, F.lit(SPACE))
    odd = F.contains(line, F.lit("  "))
    for mark in SPACE[1:]:
        odd = odd | F.contains(line, F.lit(mark))
    return F.when(odd, F.regexp_replace(line, SPACES, " ")).otherwise(line)


def _words(line: Column) -> Column:
    return F.split(_one_spaced(line), " ")


def _blank(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACE))) == 0


def _half_keys(w: Column) -> Column:
    """Hashes of a line's first and last words, nearly half of them each.

    The number of words taken hardly depends on the length: of two lines one word apart, both
    give the halves of the shorter one, and one of these halves has no edit in it.
    """
    def halves(n):
        a = F.greatest(4 * F.floor(n / 8), F.lit(2)).cast("int")
        return F.array(F.xxhash64(F.lit(0), F.slice(w, 1, a)), F.xxhash64(F.lit(1), F.slice(w, -a, a)))

    n = F.size(w)
    return F.when((n > MIN_WORDS) & (n % 8 == 0), F.concat(halves(n), halves(n - 1))).when(
        n >= MIN_WORDS, halves(n))


def _lines(rows: DataFrame) -> DataFrame:
    """Each line with a word: its place (_d, _t, i), two hashes and half keys."""
    exploded = rows.select("_d", "_t", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    return exploded.where(~_blank(F.col("line"))).select(
        "_d", "_t", "i", _one_spaced(F.col("line")).alias("s")).select(
        "_d", "_t", "i", "s", F.split("s", " ").alias("w")).select(
        "_d", "_t", "i", F.xxhash64("s").alias("m1"), F.xxhash64(F.lit(1), "s").alias("m2"),
        _half_keys(F.col("w")).alias("halves"))


def _running(values: Column) -> Column:
    """Exclusive ors of the first 0, 1, 2 ... values."""
    start = F.struct(F.lit(0).cast("bigint").alias("x"), F.array(F.lit(0).cast("bigint")).alias("p"))

    def step(acc, v):
        x = acc["x"].bitwiseXOR(v)
        return F.struct(x.alias("x"), F.concat(acc["p"], F.array(x)).alias("p"))

    return F.aggregate(values, start, step, lambda acc: acc["p"])


def _running_long(values: Column) -> Column:
    """The same, block by block: an array that grows is copied for each value, so it must not
    grow as long as a line can be."""
    firsts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
    parts = F.transform(firsts, lambda i: F.slice(_running(
        F.slice(values, i * BLOCK + 1, F.lit(BLOCK))), 2, BLOCK))

    def joined(blocks):
        totals = _running(F.transform(blocks, lambda p: F.element_at(p, -1)))
        return let(totals, lambda t: F.flatten(F.transform(
            blocks, lambda p, i: F.transform(p, lambda x: x.bitwiseXOR(F.get(t, i))))))

    return F.concat(F.array(F.lit(0).cast("bigint")), let(parts, joined))


OPEN, WHOLE, SHORT = 0, 1, 2


def _variants(texts: DataFrame) -> DataFrame:
    """(id, v, role) for all keys of the lines (id, w) within one edit: with one word left
    open, the whole line, and the line without one word.

    A line's key is the exclusive or of its words' hashes, each hashed with its place. The
    line without word j has the words before it as they are and those behind it moved by one.
    """
    def places(by):
        return F.transform("w", lambda x, k: F.xxhash64(k + by, x))

    hashed = texts.select("id", F.size("w").alias("n"), places(0).alias("here"),
                          places(-1).alias("moved"))

    def sums(rows, running):
        return rows.select("id", "n", "here", running(F.col("here")).alias("p"),
                           running(F.col("moved")).alias("q"))

    def key(role, *parts):
        return F.struct(F.xxhash64(*parts).alias("v"), F.lit(role).alias("role"))

    def keys(j):
        n = F.col("n")
        whole = F.get("p", n)
        opened = key(OPEN, n, j, whole.bitwiseXOR(F.get("here", j)))
        short = key(SHORT, n - 1, F.get("p", j).bitwiseXOR(F.get("q", n)).bitwiseXOR(F.get("q", j + 1)))
        return F.when(j == n, F.array(key(WHOLE, n, whole))).when(
            n > MIN_WORDS, F.array(opened, short)).otherwise(F.array(opened))

    every = F.sequence(F.lit(0), F.col("n"))
    each = sums(hashed.where(F.col("n") <= LONG), _running).select("*", F.explode(every).alias("j"))
    long = sums(hashed.where(F.col("n") > LONG), _running_long)
    return each.select("id", F.inline(keys(F.col("j")))).unionByName(
        long.select("id", F.inline(F.flatten(F.transform(every, keys)))))


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word sequences differ by at most one edit."""
    def after(p):
        def rest(x, skip):
            return F.slice(x, p + skip, F.greatest(F.size(x) - p, F.lit(0)) + 1)

        return (
            F.when(F.size(a) == F.size(b), rest(a, 2) == rest(b, 2))
            .when(F.size(a) == F.size(b) + 1, rest(a, 2) == rest(b, 1))
            .when(F.size(a) + 1 == F.size(b), rest(a, 1) == rest(b, 2))
            .otherwise(F.lit(False))
        )

    differ = F.transform(F.sequence(F.lit(0), F.least(F.size(a), F.size(b)) - 1),
                         lambda k: F.get(a, k) != F.get(b, k))
    first = F.array_position(differ, F.lit(True))
    return let(F.when(first == 0, F.least(F.size(a), F.size(b))).otherwise(first - 1).cast("int"), after)


def _near_copies(rows: DataFrame, lines: DataFrame, classes: DataFrame) -> DataFrame:
    """(m1, m2): the classes of equal lines of which an earlier line is one edit away."""
    halves = lines.where("halves is not null").select("m1", "m2", F.explode("halves").alias("h"))
    shared = halves.groupBy("h").agg(F.min("m1").alias("a"), F.max("m1").alias("b")).where("a < b")
    alike = halves.join(shared.select("h"), "h", "left_semi").select("m1", "m2").distinct()
    wanted = store(
        classes.join(alike, ["m1", "m2"]).groupBy("first._d", "first._t").agg(F.collect_list(
            F.struct(F.struct("m1", "m2").alias("m"), "first")).alias("wanted")),
        "wanted",
    )
    found = rows.join(small(wanted, "wanted", 96), ["_d", "_t"]).select(F.explode(let(
        F.split("text", "\n"), lambda parts: F.transform("wanted", lambda x: F.struct(
            x["m"].alias("m"), x["first"].alias("first"),
            _words(F.get(parts, x["first"]["i"])).alias("w"))))).alias("x")).select("x.*")
    # Numbered in the order of their first places, so that the earliest is a plain minimum.
    texts = store(
        found.repartitionByRange("first").sortWithinPartitions("first").select(
            "m", F.monotonically_increasing_id().alias("id"), "w"),
        "candidates",
    )
    keyed = store(_variants(texts), "variants")

    def earliest(role):
        return F.min(F.when(F.col("role") == role, F.col("id")))

    groups = keyed.groupBy("v").agg(
        earliest(OPEN).alias("_open"), earliest(WHOLE).alias("_whole"),
        earliest(SHORT).alias("_short"),
        F.max(F.when(F.col("role") == OPEN, F.col("id"))).alias("_last"),
    ).where("_open < _last or (_whole is not null and _short is not null)").drop("_last")
    other = F.when(F.col("role") == OPEN, F.col("_open")).when(
        F.col("role") == WHOLE, F.col("_short")).otherwise(F.col("_whole"))
    pairs = keyed.join(groups, "v").select("id", other.alias("o")).where("o < id").distinct()
    theirs = texts.select(F.col("id").alias("o"), F.col("m").alias("n"), F.col("w").alias("e"))
    return pairs.join(texts, "id").join(theirs, "o").where(
        (F.col("m") != F.col("n")) & _within_one(F.col("w"), F.col("e"))
    ).select("m.m1", "m.m2").distinct()


def _judged(docs: DataFrame) -> DataFrame:
    """Rows nested, with ``gone``: the sorted places of the lines to remove, null if none."""
    rows = nest(docs).withColumn("text", F.col("row.text"))
    lines = store(_lines(rows), "lines")
    classes = store(lines.groupBy("m1", "m2").agg(
        F.min(F.struct("_d", "_t", "i")).alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    near = store(_near_copies(rows, lines, classes).withColumn("near", F.lit(True)), "near")
    judged = classes.join(near, ["m1", "m2"], "left").where("n > 1 or near")
    gone = store(
        lines.select("_d", "_t", "i", "m1", "m2").join(judged.drop("n"), ["m1", "m2"])
        .where("near or struct(_d, _t, i) <> first").select("_d", "_t", "i").distinct()
        .groupBy("_d", "_t").agg(F.sort_array(F.collect_list("i")).alias("gone")),
        "gone",
    )
    return rows.join(small(gone, "gone", 8), ["_d", "_t"], "left")


def _kept(parts: Column, gone: Column) -> Column:
    """The stretches between the lines that go, joined again."""
    def stretch(k):
        before = F.coalesce(F.get(gone, k - 1), F.lit(-1))
        until = F.coalesce(F.get(gone, k), F.size(parts))
        return F.slice(parts, before + 2, until - before - 1)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch)), "\n")


def _with_kept(judged: DataFrame) -> DataFrame:
    text = F.col("text")
    kept = F.when(F.col("gone").isNull(), text).otherwise(
        let(F.split(text, "\n"), lambda parts: let(F.col("gone"), lambda g: _kept(parts, g))))
    lines = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: ~_blank(x)))
    return judged.select(
        "row", kept.alias("_kept"), lines.cast("long").alias("_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("_removed"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (with a word), n_removed and the text that is left, of each row.

    A line goes if an equal or near line comes earlier, by doc_id and place in the text;
    lines are judged on the input, so a line may go for one that goes itself. Words are what
    stands between white space, so lines that differ in white space only are equal. Lines
    without a word stay. A null text stays null, a null doc_id comes last. Rows equal in id
    and text are one document and keep the same lines. An empty table gives an empty one.
    """
    return _with_kept(_judged(docs.select("doc_id", "text"))).select(
        "row.doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"),
        F.col("_kept").alias("text"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with what is left of each text; documents that lose all their lines go, those
    that had none stay. Other columns, whatever their names, are kept."""
    left = _with_kept(_judged(docs)).where("_lines = 0 or _removed < _lines")
    return unnest(left.withColumn("row", F.col("row").withField("text", F.col("_kept"))), docs.columns)
