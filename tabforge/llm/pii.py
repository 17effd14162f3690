"""Personal data, and the terms that give it away, in DataFrame functions only.

Base spans are leftmost non-overlapping matches of four patterns. None of them can reach across
a line break, so texts are worked on line by line and only lines that may hold a match are
taken apart.

The method goes on from the values found, the protected entities, and the terms (words with a
letter) within ``CONTEXT`` characters of them on their line. With lines as events, the corpus
gives each entity its information content, -ln p(e), and each term near it the pointwise mutual
information, ln(p(e, t) / (p(e) p(t))). Their ratio is the part of the entity that the term
discloses: 1 if the term never occurs without it. Terms seen with an entity on several different
lines that disclose at least ``generalise`` of it are replaced by their class wherever they
stand near that entity; from ``remove`` on they are taken out. With ``everywhere``, the events are
whole texts instead, and all words of a text are looked at, however far they stand from the entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabforge.llm.common import whole_text
from tabforge.session import materialize

KINDS = ("email", "ip", "card", "phone", "term")

# The four base patterns, written so that a failed attempt is never repeated inside the same run
# of characters: a match can only begin where such a run does, or where the last match ended.
LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Runs of 13 to 19 digits with at most one blank or hyphen between two of them.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Whether a line can hold a match of any kind.
MAYBE = r"@|\+[0-9]|[0-9]\.[0-9]++\.[0-9]|[0-9](?:[\x20-]?[0-9]){12}"
WORD = r"[\p{L}\p{N}]+"
# Words outside e-mail addresses: an address is taken as a whole first, and is no word.
TERM = rf"{PATTERNS['email']}|{WORD}"
CONTEXT = 160
CHUNK = 256


def starts(lengths: Column) -> Column:
    """Sums of the numbers before each place of an array.

    Appending to an array copies it, so sums are taken over chunks first; the work grows little
    faster than the array.
    """
    def running(values: Column, first: Column) -> Column:
        begin = F.struct(first.cast("long").alias("at"),
                         F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(values, begin, lambda s, x: F.struct(
            (s["at"] + x).alias("at"), F.array_append(s["out"], s["at"]).alias("out")))["out"]

    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")),
        lambda i: F.slice(lengths, i * CHUNK + 1, F.lit(CHUNK)))
    sums = F.transform(chunks, lambda c: F.aggregate(
        c, F.lit(0).cast("long"), lambda s, x: s + x))
    parts = F.zip_with(chunks, running(sums, F.lit(0)), running)
    return F.when(F.size(lengths) > 0, F.flatten(parts)).otherwise(
        F.array().cast("array<bigint>"))


def cut(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Add the matches of a pattern, the text between them, and where each of both begins."""
    return df.withColumn(f"{name}_found", F.regexp_extract_all(
        text, F.lit(pattern), F.lit(0))).withColumn(
        f"{name}_gaps", F.when(F.size(f"{name}_found") > 0, F.split(text, pattern, -1))).withColumn(
        f"{name}_at", F.when(F.size(f"{name}_found") > 0, starts(F.zip_with(
            F.slice(f"{name}_gaps", F.lit(1), F.size(f"{name}_found")), f"{name}_found",
            lambda g, v: F.length(g) + F.length(v)))))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the checksum: every second one from the right counts double."""
    figures = F.reverse(F.split(number, ""))
    weighted = F.transform(figures, lambda d, i: F.when(
        i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d >= "5", 9).otherwise(0)))
    return F.aggregate(weighted, F.lit(0), lambda s, x: s + x) % 10 == 0


# A number from 0 to 255, with any zeros before it.
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def entity(kind: str, value: Column) -> Column:
    """The protected value without differences of writing: case, blanks, signs."""
    if kind == "email":
        return F.lower(value)
    return F.concat(F.lit(f"{kind}:"), value if kind == "ip" else digits(value))


MENTIONS = "array<struct<kind:int,start:bigint,end:bigint,entity:string,before:string,after:string>>"


def kept_mentions(kind: str, number: int) -> Column:
    """Valid matches of a kind from the columns that ``cut`` has added, with their contexts.

    Words that the limit of the context cuts are left out of it.
    """
    at, gaps = F.col(f"{kind}_at"), F.col(f"{kind}_gaps")
    every = F.transform(F.col(f"{kind}_found"), lambda v, i: F.struct(
        (at[i] + F.length(gaps[i])).alias("start"),
        (at[i] + F.length(gaps[i]) + F.length(v)).alias("end"), v.alias("value"),
        gaps[i].alias("before"), gaps[i + 1].alias("after")))

    def mention(m: Column) -> Column:
        before = F.when(F.length(m["before"]) > CONTEXT, F.regexp_replace(
            F.right(m["before"], F.lit(CONTEXT)), f"^{WORD}", "")).otherwise(m["before"])
        after = F.when(F.length(m["after"]) > CONTEXT, F.regexp_replace(
            F.left(m["after"], F.lit(CONTEXT)), f"{WORD}$", "")).otherwise(m["after"])
        return F.struct(F.lit(number).alias("kind"), m["start"].alias("start"),
                        m["end"].alias("end"), entity(kind, m["value"]).alias("entity"),
                        before.alias("before"), after.alias("after"))

    held = F.filter(every, lambda m: valid(kind, m["value"]))
    return F.when(F.size(f"{kind}_found") > 0, F.transform(held, mention))


def with_mentions(lines: DataFrame) -> DataFrame:
    """Add ``mentions``, the base spans of ``line`` with the text around them on the line."""
    for kind, pattern in PATTERNS.items():
        lines = cut(lines, "line", pattern, kind)
    parts = [F.coalesce(kept_mentions(kind, i), F.array().cast(MENTIONS))
             for i, kind in enumerate(PATTERNS)]
    extra = [f"{k}_{x}" for k in PATTERNS for x in ("found", "gaps", "at")]
    return lines.withColumn("mentions", F.concat(*parts)).drop(*extra)


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row, doc_id, at (start in the text), line and mentions of every line that has a base span.

    Every document has at least one row; ``line`` is null where none of its lines can hold a span.
    ``row`` tells apart rows of one id and is stable only once the result is written.
    """
    text = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    split = text.withColumn("lines", F.when(F.col("text").rlike(MAYBE), F.split("text", "\n")))
    placed = split.select("row", "doc_id", "lines", F.when(
        F.col("lines").isNotNull(), starts(F.transform("lines", lambda x: F.length(x) + 1)))
        .alias("at"))
    able = F.filter(F.arrays_zip(F.col("at").alias("at"), F.col("lines").alias("line")),
                    lambda x: x["line"].rlike(MAYBE))
    rows = placed.select("row", "doc_id", F.explode_outer(able).alias("x"))
    return with_mentions(rows.select("row", "doc_id", "x.at", "x.line"))


def _words(begin: Column) -> Column:
    """term, start and size of the words with a letter that ``cut`` has found under the name t."""
    words = F.transform(F.col("t_found"), lambda v, i: F.struct(
        F.lower(v).alias("term"),
        (begin + F.col("t_at")[i] + F.length(F.col("t_gaps")[i])).alias("start"),
        F.length(v).alias("size")))
    return F.filter(words, lambda w: w["term"].rlike(rf"^{WORD}$") & w["term"].rlike(r"\p{L}"))


def nearby_terms(lines: DataFrame) -> DataFrame:
    """row, at, line_hash, entity, term, start, end: words in the contexts of all mentions."""
    sides = lines.select(
        "row", "at", F.xxhash64("line").alias("line_hash"), F.explode("mentions").alias("m"))
    sides = sides.select("row", "at", "line_hash", "m.entity", F.explode(F.array(
        F.struct((F.col("m.start") - F.length("m.before")).alias("begin"),
                 F.col("m.before").alias("side")),
        F.struct(F.col("m.end").alias("begin"), F.col("m.after").alias("side")))).alias("s"))
    sides = cut(sides.select("row", "at", "line_hash", "entity", "s.begin", "s.side"),
                "side", TERM, "t")
    words = _words(F.col("at") + F.col("begin"))
    out = sides.select("row", "at", "line_hash", "entity", F.explode(words).alias("w"))
    return out.select("row", "at", "line_hash", "entity", "w.term", "w.start",
                      (F.col("w.start") + F.col("w.size")).alias("end"))


def all_terms(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """row, text_hash, term, start, end: all words of the texts that have a base span."""
    held = lines.filter(F.size("mentions") > 0).select("row").distinct()
    # Texts that cannot hold a span are not shuffled for the join.
    able = texts.filter(F.col("text").rlike(MAYBE))
    found = cut(able.join(held, "row", "left_semi").select(
        "row", F.xxhash64("text").alias("text_hash"), "text"), "text", TERM, "t")
    out = found.select("row", "text_hash", F.explode(_words(F.lit(0))).alias("w"))
    return out.select("row", "text_hash", "w.term", "w.start",
                      (F.col("w.start") + F.col("w.size")).alias("end"))


def shared_texts(lines: DataFrame, terms: DataFrame, words: DataFrame, generalise: float = 0.9,
                 support: int = 2, **_) -> DataFrame:
    """row, at, line_hash, entity, term: the pairs in each text that may disclose enough.

    At most all n(e) texts of an entity hold the term, so a ratio of ``generalise`` needs
    n(t) <= N (n(e) / N) ** generalise. What is more frequent is not paired, which loses nothing.
    """
    total = words.filter("term = ''").agg(F.coalesce(F.max("n_term"), F.lit(1))).first()[0]
    held = lines.select("row", F.explode("mentions.entity").alias("entity")).distinct()
    able = held.groupBy("entity").agg(F.count("*").alias("n")).filter(F.col("n") >= support)
    able = able.select("entity", (total * F.pow(F.col("n") / F.lit(float(total)), F.lit(
        float(generalise))) + 1e-6).alias("most"))
    held = held.join(able, "entity")
    rare = terms.select("row", "text_hash", "term").distinct().join(
        held.groupBy("row").agg(F.max("most").alias("row_most")), "row").join(words, "term")
    rare = rare.filter("n_term <= row_most").select("row", "text_hash", "term", "n_term")
    return held.join(rare, "row").filter("n_term <= most").select(
        "row", F.lit(0).cast("long").alias("at"), F.col("text_hash").alias("line_hash"), "entity",
        "term")


def term_lines(docs: DataFrame, text_col: str = "text", whole: bool = False) -> DataFrame:
    """term, n_term: on how many lines of the corpus each word occurs; '' counts all lines.

    With ``whole``, in how many texts.
    """
    text = whole_text(text_col)
    lines = docs.select(text.alias("line") if whole else F.explode(F.split(text, "\n")).alias("line"))
    words = F.array_distinct(F.split(F.lower("line"), r"[^\p{L}\p{N}]+"))
    # One empty word a line, whatever the line begins or ends with.
    terms = F.array_append(F.filter(words, lambda w: w != ""), F.lit(""))
    return lines.select(F.explode(terms).alias("term")).groupBy("term").agg(
        F.count("*").alias("n_term"))


def disclosures(lines: DataFrame, terms: DataFrame, words: DataFrame, generalise: float = 0.9,
                remove: float = 1.0, support: int = 2) -> DataFrame:
    """entity, term, ratio and action of the terms that disclose enough of an entity.

    ``lines`` are document lines, ``terms`` their nearby terms, ``words`` the corpus counts.
    """
    total = words.filter("term = ''").agg(F.coalesce(F.max("n_term"), F.lit(1))).first()[0]
    held = lines.select("row", "at", F.explode("mentions").alias("m")).select(
        "row", "at", "m.entity").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = terms.groupBy("entity", "term", "row", "at", "line_hash").agg(F.lit(1).alias("one"))
    pairs = pairs.groupBy("entity", "term", "line_hash").agg(F.count("*").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(
        F.sum("n").alias("n_pair"), F.count("*").alias("different"))
    pairs = pairs.filter(F.col("different") >= support)
    known = pairs.join(held, "entity").join(words, "term")
    content = F.log(F.lit(float(total)) / F.col("n_entity"))
    shared = F.log(F.col("n_pair") * F.lit(float(total)) / (F.col("n_entity") * F.col("n_term")))
    ratio = F.when(content > 0, F.least(shared / content, F.lit(1.0)))
    told = known.select("entity", "term", ratio.alias("ratio")).filter(
        F.col("ratio") >= generalise)
    return told.withColumn("action", F.when(
        F.col("ratio") >= remove - 1e-9, "remove").otherwise("generalise"))


def spans_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             everywhere: bool = False, near: bool | None = None, **limits) -> DataFrame:
    """row, doc_id and spans (kind, start, end, action) of every document, in order of kind, start.

    Null and empty texts, and texts without personal data, have no spans: terms are looked for
    only near base spans or, with ``everywhere``, in the whole of a text that has one. With
    ``near`` as well both kinds of terms are given; one that both find is taken out if either says
    so. Repeated rows are documents of their own. Other columns are not read, so their names
    cannot clash. An empty table gives an empty result.
    """
    near = not everywhere if near is None else near
    found = []
    if everywhere:
        texts = materialize(docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text")))
        lines = document_lines(texts, "row", "text").drop("row").withColumnRenamed("doc_id", "row")
        lines = materialize(lines.join(texts.select("row", "doc_id"), "row"))
        terms = materialize(all_terms(texts, lines))
        words = materialize(term_lines(texts, whole=True))
        pairs = materialize(shared_texts(lines, terms, words, **limits))
        told = disclosures(lines.withColumn("at", F.lit(0).cast("long")), pairs, words, **limits)
        told = pairs.select("row", "entity", "term").join(told, ["entity", "term"])
        found.append(terms.join(told.select("row", "term", "action").distinct(), ["row", "term"]))
    else:
        lines = materialize(document_lines(docs, id_col, text_col))
    if near:
        terms = materialize(nearby_terms(lines))
        told = disclosures(lines, terms, materialize(term_lines(docs, text_col)), **limits)
        found.append(terms.join(told, ["entity", "term"]))
    found = reduce(DataFrame.unionByName, [
        x.select("row", "start", "end", "action") for x in found])
    base = lines.select("row", "doc_id", F.transform("mentions", lambda m: F.struct(
        m["kind"].alias("kind"), (F.col("at") + m["start"]).alias("start"),
        (F.col("at") + m["end"]).alias("end"), F.lit("mask").alias("action"))).alias("spans"))
    added = found.groupBy("row", "start", "end").agg(
        F.max("action").alias("action"))  # "remove" is above "generalise"
    added = added.select("row", F.lit(None).cast("long").alias("doc_id"), F.array(F.struct(
        F.lit(KINDS.index("term")).alias("kind"), "start", "end", "action")).alias("spans"))
    whole = base.unionByName(added).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.flatten(F.collect_list("spans")).alias("spans"))
    first = F.filter("spans", lambda s: s["kind"] < 4)
    clear = F.filter("spans", lambda t: (t["kind"] < 4) | ~F.exists(
        "first", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return whole.withColumn("first", first).select(
        "row", "doc_id", F.array_sort(clear).alias("spans"))


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def report(spans: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans as text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 4)
    return spans.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              **limits) -> DataFrame:
    """row, doc_id and text with base spans masked by kind and disclosing terms replaced.

    A generalised term becomes its class, ``[name]`` if it is capitalised, else ``[word]``.
    Of spans that overlap, the one that begins first is replaced.
    """
    text = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       whole_text(text_col).alias("text"))
    text = materialize(text.withColumn("row", F.monotonically_increasing_id()))
    found = spans_of(text, "row", "text", **limits).select(
        F.col("doc_id").alias("row"), "spans")
    lines = text.withColumn("lines", F.split("text", "\n")).withColumn(
        "at", starts(F.transform("lines", lambda x: F.length(x) + 1)))
    lines = lines.select("row", "doc_id", F.explode(F.arrays_zip("at", "lines")).alias("x"))
    lines = lines.select("row", "doc_id", "x.at", F.col("x.lines").alias("line"))
    # Spans and line starts in one order: each span belongs to the last line that begins before it.
    marks = found.select("row", F.explode("spans").alias("s")).select(
        "row", F.col("s.start").alias("place"), F.lit(1).alias("after"), F.col("s").alias("s"))
    starts_ = lines.select("row", F.col("at").alias("place"), F.lit(0).alias("after"),
                           F.lit(None).cast(marks.schema["s"].dataType).alias("s"))
    within = Window.partitionBy("row").orderBy("place", "after")
    owned = marks.unionByName(starts_).withColumn("at", F.last(
        F.when(F.col("after") == 0, F.col("place")), ignorenulls=True).over(within))
    owned = owned.filter("after = 1").groupBy("row", "at").agg(
        F.sort_array(F.collect_list(F.struct("place", "s"))).alias("own"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS[:4]])

    def put(state: Column, x: Column) -> Column:
        s, begin, end = x["s"], x["s"]["start"] - F.col("at"), x["s"]["end"] - F.col("at")
        old = F.expr("line").substr((begin + 1).cast("int"), (end - begin).cast("int"))
        new = (F.when(s["kind"] < 4, F.get(names, s["kind"]))
               .when(s["action"] == "remove", "")
               .when(old.rlike(r"^\p{Lu}"), "[name]").otherwise("[word]"))
        before = F.expr("line").substr(
            (state["next"] + 1).cast("int"), (begin - state["next"]).cast("int"))
        return F.when(begin < state["next"], state).otherwise(F.struct(
            end.alias("next"), F.concat(state["text"], before, new).alias("text")))

    begin = F.struct(F.lit(0).cast("long").alias("next"), F.lit("").alias("text"))
    fixed = lines.join(owned, ["row", "at"], "left").withColumn("done", F.aggregate(
        F.coalesce("own", F.array().cast(owned.schema["own"].dataType)), begin, put))
    fixed = fixed.withColumn("line", F.concat("done.text", F.expr(
        "substring(line, cast(done.next + 1 as int))")))
    return fixed.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sort_array(
        F.collect_list(F.struct("at", "line"))).alias("lines")).select(
        "row", "doc_id", F.array_join("lines.line", "\n").alias("text"))
