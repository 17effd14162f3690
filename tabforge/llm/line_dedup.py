"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame operations only.

Lines are compared as sequences of lower-cased words. Equal lines meet by a hash of all words.
For lines one word edit apart, each line emits a key for every variant with one word deleted;
equal variants meet. Lines that share a variant with the same word left out differ in that
word at most, so the earliest of them stands for the whole group and no pairs are formed; a
line that equals another's variant lacks one word of it. Candidates are then verified word by
word. Before variants are made, lines without any partner are set aside: of two lines one
edit apart, the first or the second half is the same.

Where more edits are allowed, d say, the shorter line is cut in d + 1 parts. One of them stands
unchanged in the other line, moved by few words, so lines meet by hashes of parts. All in a
block are first verified against its earliest line, and what is left against the earlier ones.
"""

from __future__ import annotations

from contextlib import ExitStack

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import whole_text
from tabforge.session import materialize, temporary


def _words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), r"\s+"), "")


def lines_of(docs: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """doc, line, words, w and two hashes of the words, for lines of at least ``least`` words."""
    base = docs.select(F.col(f"`{id_col}`").alias("doc"), whole_text(text_col).alias("text"))
    lines = base.filter("doc IS NOT NULL").select(
        "doc", F.posexplode(F.split("text", "\n")).alias("line", "raw"))
    lines = lines.select("doc", "line", _words(F.col("raw")).alias("words"))
    return lines.withColumn("w", F.size("words")).filter(F.col("w") >= least).withColumns({
        "h1": F.xxhash64("words"), "h2": F.xxhash64(F.lit("second"), F.col("words"))})


def _half_keys(near: int) -> Column:
    """Hashes of both halves, as cut in a line of this length and of one word less."""
    w, words = F.col("w"), F.col("words")
    keys = []
    for length in (w, w - 1):
        half = F.floor(length / 2).cast("int")
        keys += [
            F.xxhash64(F.lit("first"), length, F.slice(words, F.lit(1), half)),
            F.xxhash64(F.lit("second"), length, F.slice(words, w - length + half + 1, length - half)),
        ]
    return F.when(w >= near, F.array(*keys))


def _candidates(distinct: DataFrame, keys: str) -> DataFrame:
    """The distinct lines that share one of their ``keys``, as half of their words, with another line."""
    halves = distinct.filter(f"{keys} IS NOT NULL").select(
        "doc", "line", F.explode(keys).alias("half"))
    shared = halves.groupBy("half").count().filter("count > 1").select("half")
    return halves.join(shared, "half", "left_semi").select("doc", "line").distinct()


def _variants(lines: DataFrame) -> DataFrame:
    """doc, line, length, at, k1, k2: the line itself (at -1) and without its word ``at``.

    A word's hash includes its place, so the exclusive-or of a prefix and of a suffix moved up
    by one is the hash of the variant. One running window over the words of a line gives all
    its variants; the work is in proportion to the words.
    """
    lines = lines.repartition("doc", "line")  # so the words of a line are never shuffled
    words = lines.select("doc", "line", "w", F.posexplode("words").alias("at", "word"))
    names = {"e": F.col("at"), "f": F.col("at") - 1}
    for i in (1, 2):
        words = words.withColumns(
            {f"{n}{i}": F.xxhash64(F.lit(f"hash {i}"), "word", place) for n, place in names.items()})
    words = words.drop("word")
    line = "PARTITION BY doc, line"
    so_far = f"{line} ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    words = words.withColumns(
        {f"{n}{i}_so_far": F.expr(f"bit_xor({n}{i}) OVER ({so_far})")
         for n in "ef" for i in (1, 2)})
    words = words.withColumns(
        {f"{n}{i}_all": F.expr(f"bit_xor({n}{i}) OVER ({line})") for n in "ef" for i in (1, 2)})
    without = words.select("doc", "line", (F.col("w") - 1).alias("length"), "at", *[
        F.expr(f"e{i}_so_far ^ e{i} ^ f{i}_all ^ f{i}_so_far").alias(f"k{i}") for i in (1, 2)])
    itself = words.filter("at = 0").select(
        "doc", "line", F.col("w").alias("length"), F.lit(-1).alias("at"),
        F.col("e1_all").alias("k1"), F.col("e2_all").alias("k2"))
    return without.union(itself)


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one insertion, deletion or substitution apart."""
    n = F.least(F.size(a), F.size(b))
    differs = F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: x != y)
    found = F.array_position(differs, F.lit(True)).cast("int")
    before = F.when(found == 0, n).otherwise(found - 1)  # equal words at the front

    def after(words: Column, skip: Column) -> Column:
        return F.slice(words, before + skip + 1, F.greatest(F.size(words) - before - skip, F.lit(0)))

    one, none = F.lit(1), F.lit(0)
    return (F.when(F.size(a) == F.size(b), after(a, one) == after(b, one))
            .when(F.size(a) == F.size(b) + 1, after(a, one) == after(b, none))
            .when(F.size(a) + 1 == F.size(b), after(a, none) == after(b, one))
            .otherwise(False))


def _near(lines: DataFrame, stack: ExitStack) -> DataFrame:
    """doc, line, keep_doc, keep_line: the earliest line one edit away, if it is earlier."""
    variants = stack.enter_context(temporary(_variants(lines)))
    shared = variants.groupBy("k1").count().filter("count > 1").select("k1")
    variants = stack.enter_context(temporary(
        variants.join(shared, "k1", "left_semi").withColumn("me", F.struct("doc", "line"))))
    key = ["k1", "k2", "length"]
    less = variants.filter("at >= 0")
    same_place = less.groupBy(*key, "at").agg(F.min("me").alias("first"))
    longer = less.groupBy(*key).agg(F.min("me").alias("first"))
    itself = variants.filter("at < 0")
    shorter = itself.groupBy(*key).agg(F.min("me").alias("first"))
    met = less.join(same_place, [*key, "at"]).select("me", "first").union(
        itself.join(longer, key).select("me", "first")).union(
        less.join(shorter, key).select("me", "first"))
    met = met.filter("first < me").groupBy("me").agg(F.min("first").alias("first"))
    words = lines.select(F.struct("doc", "line").alias("me"), "words")
    checked = met.join(words, "me").join(words.toDF("first", "first_words"), "first")
    return checked.filter(_one_edit(F.col("words"), F.col("first_words"))).select(
        "me.doc", "me.line", F.col("first.doc").alias("keep_doc"),
        F.col("first.line").alias("keep_line"))


def _held(d: int, bounds: tuple[int, ...]) -> Column:
    """Whether the shorter of this line and one within ``d`` edits may be allowed just as many."""
    enough = F.col("w") >= bounds[d - 1]
    return enough & (F.col("w") < bounds[d] + d) if d < len(bounds) else enough


def _class_keys(bounds: tuple[int, ...]) -> Column:
    """Hashes of a line's words by class, null for classes of less than two words.

    For d edits words fall into 2 d + 1 classes. An edit changes two classes at most, so of
    lines that near one class has the same words in the same order, wherever they stand.
    """
    def keys(d: int, words: Column) -> Column:
        n = 2 * d + 1
        classes = F.transform(F.expr(f"sequence(0L, {n - 1}L)"), lambda c: F.filter(
            words, lambda x: F.pmod(x, F.lit(n).cast("long")) == c))
        made = F.transform(classes, lambda x: F.when(F.size(x) > 1, F.xxhash64(F.lit(d), x)))
        return F.when(_held(d, bounds), made).otherwise(F.expr("CAST(array() AS array<bigint>)"))

    # Words are hashed once, for the only element that the outer function is given.
    found = F.transform(F.array(F.transform("words", lambda x: F.xxhash64(x))), lambda words: F.concat(
        *[keys(d, words) for d in range(2, len(bounds) + 1)]))[0]
    return F.when(F.col("w") >= bounds[1], found)


def _part_keys(bounds: tuple[int, ...]) -> Column:
    """Hashes of parts: ``own`` ones of the line's parts, others of where parts of a line up to
    that many words shorter would stand in this line."""
    w, words = F.col("w"), F.col("hashes")

    def edits(n: Column) -> Column:
        return sum(((n >= b).cast("int") for b in bounds), F.lit(0))

    def part_keys(d: int) -> Column:
        # The first part with fewer edits up to its end than parts has none itself, ``part`` before
        # it and at most d - part after it. The former move it by ``by``, the latter by the rest
        # of ``less``.
        places = [(less, part, by) for less in range(d + 1) for part in range(d + 1)
                  for by in range(-part, part + 1) if abs(less - by) <= d - part]

        def key(p: Column) -> Column:
            length = w - p["less"]
            begin, end = (F.floor(length * (p["part"] + i) / (d + 1)).cast("int") for i in (0, 1))
            there = begin + p["by"]
            fits = (edits(length) == d) & (there >= 0) & (end + p["by"] <= w)
            return F.when(fits, F.struct(
                F.xxhash64(F.lit(d), p["part"], length, F.slice(
                    words, F.greatest(there, F.lit(0)) + 1, end - begin)).alias("key"),
                ((p["less"] == 0) & (p["by"] == 0)).alias("own")))

        return F.transform(F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(
            place, ("less", "part", "by"))]) for place in places]), key)

    keys = [part_keys(d) for d in range(2, len(bounds) + 1)]
    return F.filter(F.concat(*keys), lambda x: x.isNotNull())


def _edit_distance(a: str, b: str, most: int) -> Column:
    """Word edits between two arrays whose lengths differ by at most ``most``; a larger result
    than ``most`` only says that there are more. Rows of the table hold the band alone."""
    band = f"sequence(0, {2 * most})"
    row = f"""transform({band}, j -> least(
        s.row[j] + if(s.i + j - {most} BETWEEN 0 AND size({b}) - 1,
                      if(get({b}, s.i + j - {most}) = x, 0, 1), 999),
        coalesce(get(s.row, j + 1), 999) + 1))"""
    row = f"""transform(array({row}), t -> transform({band}, j -> array_min(
        transform(slice(t, 1, j + 1), (y, q) -> y + j - q))))[0]"""
    return F.expr(f"""aggregate({a},
        named_struct('i', 0, 'row', transform({band}, j -> if(j < {most}, 999, j - {most}))),
        (s, x) -> named_struct('i', s.i + 1, 'row', {row}),
        s -> s.row[size({b}) - size({a}) + {most}])""")


def _further(lines: DataFrame, done: DataFrame, bounds: tuple[int, ...],
             stack: ExitStack) -> DataFrame:
    """doc, line, keep_doc, keep_line, distance for lines not ``done``: an earlier line within
    as many edits as there are ``bounds`` up to the words of the shorter one."""
    keys = lines.select("doc", "line", "w", F.transform("words", lambda x: F.xxhash64(x)).alias("hashes"))
    keys = keys.select("doc", "line", F.explode(_part_keys(bounds)).alias("k"))
    keys = keys.select("doc", "line", "k.key", "k.own").repartition("key")
    keys = keys.select(F.struct("doc", "line").alias("me"), "key", "own")
    shared = keys.groupBy("key").agg(
        F.min("me").alias("low"), F.max("me").alias("high"), F.max("own").alias("owned"),
        F.min(F.when(F.col("own"), F.col("me"))).alias("owner"))
    shared = shared.filter("owned AND low < high").select("key", "low", "owner")
    keys = stack.enter_context(temporary(keys.join(shared, "key")))
    words = lines.select(F.struct("doc", "line").alias("me"), "w", "words")
    words = stack.enter_context(temporary(words.join(keys.select("me"), "me", "left_semi")))
    most = len(bounds)

    def verified(met: DataFrame) -> DataFrame:
        met = met.filter("first < me").distinct().join(words, "me").join(
            words.toDF("first", "first_w", "first_words"), "first")
        allowed = sum(((F.least("w", "first_w") >= b).cast("int") for b in bounds), F.lit(0))
        met = met.withColumn("allowed", allowed).filter(F.abs(F.col("w") - F.col("first_w")) <= F.col("allowed"))
        # An edit adds or takes away one word at most: most pairs end here, and cheaply.
        for one, other in (("words", "first_words"), ("first_words", "words")):
            met = met.filter(F.size(F.array_except(one, other)) <= F.col("allowed"))
        met = met.withColumn("distance", _edit_distance("words", "first_words", most))
        return met.filter("distance <= allowed").groupBy("me").agg(
            F.min(F.struct("first", "distance")).alias("k")).select(
            "me", "k.first", "k.distance")

    left = keys.join(done.select(F.struct("doc", "line").alias("me")), "me", "left_anti")
    stars = stack.enter_context(temporary(verified(left.select("me", F.col("owner").alias("first")).union(
        left.filter("own").select("me", F.col("low").alias("first"))))))
    left = left.join(stars.select("me"), "me", "left_anti")
    a, b = left.alias("a"), keys.alias("b")
    pairs = a.join(b, F.expr("a.key = b.key AND b.me < a.me AND (a.own OR b.own)")).select(
        F.col("a.me").alias("me"), F.col("b.me").alias("first"))
    return stars.union(verified(pairs)).select(
        "me.doc", "me.line", F.col("first.doc").alias("keep_doc"),
        F.col("first.line").alias("keep_line"), "distance")


def _words_at(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """The ``wanted`` lines with their words and w; further columns of ``wanted`` stay."""
    own = [c for c in wanted.columns if c != "doc"]
    numbers = wanted.groupBy("doc").agg(F.collect_set(F.struct(*own)).alias("numbers"))
    chosen = docs.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("t"))
    chosen = chosen.join(numbers, "doc")
    chosen = chosen.select("doc", F.explode("numbers").alias("n"), "t").select(
        "doc", "n.*", _words(F.split("t", "\n")[F.col("n.line")]).alias("words")).distinct()
    return chosen.withColumn("w", F.size("words"))


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    least_words: int = 3, near_words: int = 10,
                    more_edits: tuple[int, ...] = ()) -> DataFrame:
    """Lines for which an earlier one is equal or, from ``near_words`` words on, one edit away.

    Returns doc, line (from 0), keep_doc, keep_line (the earliest such line) and distance (0 or
    1). Earlier means a smaller (id, line number). Lines of fewer than ``least_words`` words are
    never duplicates. Words are lower-cased and cut at white space. A chain of edits counts step
    by step: a line goes if any earlier line is near, whether that one stays or not. Rows without
    an id take no part. A repeated row is the same document. The table must not give one id to
    different texts. Null and empty texts have no lines; an empty table gives no rows.

    ``more_edits`` are the numbers of words, rising, from which on one edit more is allowed; the
    shorter line counts. Such a line comes with some earlier line within the bound.
    """
    with ExitStack() as stack:
        first = stack.enter_context(ExitStack())
        bounds = (near_words, *more_edits)
        lines = lines_of(docs, id_col, text_col, least_words).withColumn(
            "halves", _half_keys(near_words))
        same = ["h1", "h2", "halves"]
        if more_edits:
            lines = lines.withColumn("classes", _class_keys(bounds))
            same.append("classes")
        lines = first.enter_context(temporary(lines.select("doc", "line", *same)))
        distinct = lines.groupBy(*same).agg(
            F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n"))
        distinct = first.enter_context(temporary(
            distinct.select(*same, "n", "first.doc", "first.line")))
        several = distinct.filter("n > 1").select(
            "h1", "h2", F.col("doc").alias("keep_doc"), F.col("line").alias("keep_line"))
        equal = lines.select("doc", "line", "h1", "h2").join(several, ["h1", "h2"]).filter(
            "doc <> keep_doc OR line <> keep_line").select(
            "doc", "line", "keep_doc", "keep_line", F.lit(0).alias("distance"))
        wanted = _candidates(distinct, "halves")
        if not more_edits:
            wanted = stack.enter_context(temporary(wanted))
            chosen = stack.enter_context(temporary(_words_at(docs, id_col, text_col, wanted)))
            near = _near(chosen, stack).withColumn("distance", F.lit(1))
            return materialize(equal.union(near).distinct())
        equal = stack.enter_context(temporary(equal))
        # Too few words make no key, since many lines would have it: those lines are wanted.
        few = distinct.filter("exists(classes, x -> x IS NULL)").select("doc", "line")
        wanted = wanted.withColumns({"one": F.lit(True), "more": F.lit(False)}).union(
            _candidates(distinct, "classes").union(few).withColumns(
                {"one": F.lit(False), "more": F.lit(True)}))
        wanted = stack.enter_context(temporary(wanted.groupBy("doc", "line").agg(
            F.max("one").alias("one"), F.max("more").alias("more"))))
        first.close()  # the hashes of all lines
        # One pass over the texts gives the words for both comparisons.
        chosen = stack.enter_context(temporary(_words_at(docs, id_col, text_col, wanted)))
        with ExitStack() as held:
            near = _near(chosen.filter("one").drop("one", "more"), held)
            near = stack.enter_context(temporary(near.withColumn("distance", F.lit(1))))
        further = _further(chosen.filter("more"), near, bounds, stack)
        return materialize(equal.union(near).union(further).distinct())


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped and the dropped lines in order."""
    gone = _gone_by_doc(docs, id_col, text_col, **options)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       F.size(F.split(whole_text(text_col), "\n")).alias("n_lines"))
    rows = rows.join(gone, "doc_id", "left")
    empty = F.expr("CAST(array() AS array<struct<line:int,keep_doc:bigint,keep_line:int,distance:int>>)")
    return rows.select("doc_id", "n_lines", F.coalesce(F.size("gone"), F.lit(0)).alias("n_dropped"),
                       F.coalesce("gone", empty).alias("dropped"))


def _gone_by_doc(docs: DataFrame, id_col: str, text_col: str, **options) -> DataFrame:
    """doc_id and its duplicate lines; a document's lines meet, never more."""
    found = duplicate_lines(docs, id_col, text_col, **options)
    one = found.groupBy("doc", "line").agg(
        F.min(F.struct("distance", "keep_doc", "keep_line")).alias("k"))
    return one.groupBy(F.col("doc").alias("doc_id")).agg(F.sort_array(F.collect_list(F.struct(
        "line", F.col("k.keep_doc").cast("long").alias("keep_doc"),
        F.col("k.keep_line").alias("keep_line"), F.col("k.distance").alias("distance")))).alias("gone"))


def without_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            **options) -> DataFrame:
    """The documents with duplicate lines taken out; columns and their order stay.

    A document that loses every line, or all but blank ones, goes. Others keep their row, also
    if nothing was lost.
    """
    gone = _gone_by_doc(docs, id_col, text_col, **options).select(
        F.col("doc_id").alias("__doc"), F.col("gone.line").alias("__gone"))
    rows = docs.join(gone, F.col(f"`{id_col}`") == F.col("__doc"), "left")
    rows = rows.withColumn("__lines", F.split(f"`{text_col}`", "\n")).withColumn(
        "__kept", F.expr("array_except(sequence(0, size(__lines) - 1), __gone)"))
    rows = rows.filter(r"__gone IS NULL OR exists(__kept, i -> __lines[i] RLIKE '\\S')")
    kept = F.expr("array_join(transform(__kept, i -> __lines[i]), '\n')")
    new = F.when(F.col("__gone").isNull(), F.col(f"`{text_col}`")).otherwise(kept)
    return rows.select(*[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
