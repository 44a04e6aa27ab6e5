"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Fixed patterns find e-mail addresses, IP addresses, payment cards and phone
numbers; these are the seeds. Texts are then read as words: punctuation stands
alone, digit groups with single spaces between them are one word, a seed is one
word that shows only its kind. Every word has two lexical patterns: the two
words before it, and the words on either side, digits being alike; seeds and
other words get them from the same array of words.

Spark scores the graph of patterns and instances. A pattern is *looked up* when
``SUPPORT`` different known instances stand in it and at least half of all the
words that stand in it are known; so what a look-up finds is no more than what
is known already. It is *trusted* when a share of ``CONFIDENCE`` of its different
instances is known, and then all of them are. Both go on until nothing changes:
trust inside what was looked up, then another look at the texts for the other
patterns of the instances that became known. Instances of trusted patterns are
identifiers that the fixed patterns do not know; their spans are added.

The texts are read without Python, once for the seeds and twice a round: to count
the words in patterns not counted yet (one sum a pattern leaves a task) and to look
up those patterns that qualify. Without a qualifying pattern there is no second look, and
without a new instance no second round. Positions are worked out only for texts
with a discovered instance, from prefix sums of word lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hedonic.llm.frames import open_frame
from hedonic.session import bounded_broadcast, materialise

KINDS = ["email", "ip", "card", "phone"]
FOUND = "context"

# The contract's patterns. Possessive quantifiers and look-behinds only spare backtracking: they
# change no match, as what follows each repeated class cannot begin with a member of it.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Characters of a chunk when a text is cut up for masking and redaction.
CHUNK = 4096
#: Rows of patterns, instances or hits that are broadcast at most (some 50 bytes each).
BROADCAST_ROWS = 500_000
#: A pattern is looked up with so many different known instances, and if a share of its words is known.
SUPPORT, SPECIFIC = 5, 0.5
#: It is trusted if this share of its different instances is known.
CONFIDENCE = 0.9

SPACES = r" \t\n\x0B\f\r"
#: Stand alone as words.
PUNCTUATION = r""":,;()<>"'=\[\]{}|!?*#&"""
#: Ends of a word that are not part of an instance.
LEADING, TRAILING = "._%/-", "._%+/-@"
#: A masked seed's first and last character.
OPEN, CLOSE = "\ue000", "\ue001"
#: A word, which may hold single spaces between digits; a character of punctuation; a masked seed.
WORD = (rf"(?:[^{SPACES}{PUNCTUATION}{OPEN}]++(?:(?<=[0-9]) (?=[0-9]))?+)++|[{PUNCTUATION}]"
        rf"|{OPEN}[^{CLOSE}]*+{CLOSE}")

_BYTE = r"(?:0++|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?))"


def running_sums(a: Column) -> Column:
    """Prefix sums of an array of longs, in chunks of the root of its size (n^1.5 steps for n entries)."""
    zero = F.lit(0).cast("long")
    none = F.array().cast("array<bigint>")

    def sums(x: Column) -> Column:
        return F.aggregate(x, F.struct(zero.alias("s"), none.alias("out")),
                           lambda acc, v: F.struct((acc["s"] + v).alias("s"),
                                                   F.concat(acc["out"], F.array(acc["s"] + v)).alias("out")),
                           lambda acc: acc["out"])

    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(a))).cast("int"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / size).cast("int")),
                         lambda c: F.slice(a, c * size + 1, size))
    inside = F.transform(chunks, sums)
    # the sums before each chunk: running sums of the chunks' totals, less the chunk's own
    totals = F.transform(chunks, lambda c: F.aggregate(c, zero, lambda s, v: s + v))
    before = F.zip_with(sums(totals), totals, lambda s, t: s - t)
    return F.when(F.size(a) == 0, none).otherwise(
        F.flatten(F.zip_with(inside, before, lambda c, b: F.transform(c, lambda v: v + b))))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        d = F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return total + d

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


_ITEM = "array<struct<start:bigint,rank:int,kind:string,end:bigint,value:string>>"


def add_occurrences(df: DataFrame, text: str) -> DataFrame:
    """Adds ``items``: every valid base match, with its span."""
    none, no_items = F.array().cast("array<string>"), F.array().cast(_ITEM)
    body = F.col("body")
    df = df.withColumn("body", F.coalesce(F.col(text).cast("string"), F.lit("")))
    digit = body.rlike("[0-9]")
    needs = {"email": F.contains(body, F.lit("@")), "phone": F.contains(body, F.lit("+")), "ip": digit, "card": digit}
    df = df.withColumns({f"m_{k}": F.when(needs[k], F.regexp_extract_all(body, F.lit(r), F.lit(0))).otherwise(none)
                         for k, r in PATTERNS.items()})
    # the text between matches; with limit -1 there is one part more than matches
    df = df.withColumns({f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split(body, r, -1)).otherwise(none)
                         for k, r in PATTERNS.items()})
    df = df.withColumns({f"e_{k}": running_sums(F.zip_with(
        F.col(f"m_{k}"), F.slice(f"p_{k}", 1, F.size(f"m_{k}")),
        lambda m, p: (F.length(m) + F.length(p)).cast("long"))) for k in PATTERNS})

    def items(k: str, rank: int) -> Column:
        m, e = F.col(f"m_{k}"), F.col(f"e_{k}")

        def item(i: Column) -> Column:
            value = F.element_at(m, i)
            return F.struct((F.element_at(e, i) - F.length(value)).alias("start"), F.lit(rank).alias("rank"),
                            F.lit(k).alias("kind"), F.element_at(e, i).cast("long").alias("end"), value.alias("value"))

        every = F.filter(F.transform(F.sequence(F.lit(1), F.size(m)), item), lambda x: _valid(k, x["value"]))
        return F.when(F.size(m) == 0, no_items).otherwise(every.cast(_ITEM))

    return df.withColumn("items", F.concat(*[items(k, i) for i, k in enumerate(KINDS)])).drop(
        "body", *[f"{x}_{k}" for x in "mpe" for k in PATTERNS])


# ---------------------------------------------------------------- words and their patterns
def plain(text: Column) -> Column:
    """Lower case, without the masks' first character; every character stays one."""
    return F.lower(F.replace(F.replace(text, F.lit("\u0130"), F.lit("i")), F.lit(OPEN), F.lit("?")))


def _solid(text: Column) -> Column:
    """Number of characters that are no spaces."""
    return F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long")


def _cutter(body: Column):
    """Function of (from, to) that cuts a text without scanning it from its beginning."""
    chunks = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))

    def cut(a: Column, b: Column) -> Column:
        first, last = F.floor(a / CHUNK).cast("int"), F.floor((b - 1) / CHUNK).cast("int")
        one = F.substring(F.element_at(chunks, first + 1), (a % CHUNK + 1).cast("int"), (b - a).cast("int"))
        many = F.concat(F.substring(F.element_at(chunks, first + 1), (a % CHUNK + 1).cast("int"), F.lit(CHUNK)),
                        F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
                        F.substring(F.element_at(chunks, last + 1), F.lit(1), ((b - 1) % CHUNK + 1).cast("int")))
        return F.when(b <= a, "").when(first == last, one).otherwise(many)

    return cut


def replace_spans(body: Column, spans: Column, label) -> Column:
    """The text with ``label(span, from, cut)`` for what each span (sorted by start) covers that none before it does."""
    cut = _cutter(body)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        begin = F.greatest(acc["at"], s["start"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["end"] > acc["at"], F.concat(acc["out"], F.array(
                            cut(acc["at"], begin), label(s, begin, cut)))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.array_join(
        F.concat(acc["out"], F.array(cut(acc["at"], F.length(body).cast("long")))), ""))


def _masked(body: str, shown) -> Column:
    """The text with each seed as one word: the opening mark, ``shown(seed, characters that are no spaces)``, the closing
    mark. What a seed covers beyond one before it is a word of its own, shown as that of a null seed."""
    def label(s: Column, begin: Column, cut) -> Column:
        return F.concat(F.lit(OPEN), shown(F.when(begin == s["start"], s), _solid(cut(begin, s["end"]))), F.lit(CLOSE))

    return F.when(F.size("items") > 0, replace_spans(F.col(body), F.col("items"), label)).otherwise(F.col(body))


def add_words(scanned: DataFrame, words: bool = True) -> DataFrame:
    """``row``, ``context``: the words as their neighbours see them, digits being alike and seeds their kind; and
    ``words``: as they are, seeds a key of the value, an x and their length."""
    df = scanned.select("row", F.array_sort("items").alias("items"),
                        plain(F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("b"))
    df = df.withColumn("c", _masked("b", lambda s, n: F.coalesce(s["kind"], F.lit("rest"))))
    df = df.withColumn("c", F.regexp_replace("c", "[1-9]", "0"))
    df = df.withColumn("context", F.regexp_extract_all("c", F.lit(WORD), F.lit(0)))
    if words:
        key = lambda s: F.coalesce(F.lower(F.hex(F.xxhash64(s["value"]))), F.lit("rest"))
        df = df.withColumn("items", F.transform("items", lambda s: s.withField("value", F.lower(s["value"]))))
        df = df.withColumn("w", _masked("b", lambda s, n: F.concat(key(s), F.lit("x"), n.cast("string"))))
        df = df.withColumn("words", F.regexp_extract_all("w", F.lit(WORD), F.lit(0)))
    return df.select("row", "context", *["words"] * words)


def occurrences(scanned: DataFrame, words: bool = True) -> DataFrame:
    """``row, i, word, pattern``: both patterns of every word, but for the first of a text, which has only the second.
    Without ``words`` a word is what its neighbours see."""
    df = add_words(scanned.select("row", "source", "items"), words)
    c, none = F.col("context"), F.array(F.lit(""))
    n = F.size(c)
    df = df.select("row", F.posexplode(F.arrays_zip(
        F.col("words" if words else "context").alias("w"), F.slice(F.concat(none, none, c), F.lit(1), n).alias("p"),
        F.slice(F.concat(none, c), F.lit(1), n).alias("q"), F.slice(F.concat(c, none), F.lit(2), n).alias("r"))))
    left = F.when(F.col("col.q") != "", F.xxhash64(F.lit("L"), "col.p", "col.q"))
    both = F.xxhash64(F.lit("B"), "col.q", "col.r")
    return df.select("row", F.col("pos").alias("i"), F.col("col.w").alias("word"), F.explode(F.array(left, both)).alias(
        "pattern")).where("pattern IS NOT NULL")


def is_seed(word: Column) -> Column:
    return F.startswith(word, F.lit(OPEN))


def instance_of(word: Column) -> Column:
    """What is known or not: a seed's key, or a word without the points and dashes at its ends; null for none."""
    bare = F.ltrim(F.rtrim(word, F.lit(TRAILING)), F.lit(LEADING))
    return F.when(is_seed(word), F.when(~F.startswith(word, F.lit(OPEN + "rest")), F.substring_index(word, "x", 1))) \
            .otherwise(F.when(bare.rlike(r"[\p{L}\p{N}]"), bare))


def _few(df: DataFrame) -> DataFrame:
    return bounded_broadcast(df, BROADCAST_ROWS)


# ---------------------------------------------------------------- the graph
def settle(pairs: DataFrame, known: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(trusted patterns, all known instances) of distinct (pattern, instance) and the instances known at first: a
    pattern is trusted by the share of known ones, and its instances are known then, until nothing changes."""
    trusted, n = None, 0
    while True:
        of = pairs.join(known.withColumn("k", F.lit(1)), "instance", "left").groupBy("pattern").agg(
            F.count("k").alias("known"), F.count("*").alias("n"))
        trusted = materialise(of.where((F.col("known") >= support) & (F.col("known") >= confidence * F.col("n"))).select("pattern"))
        now = trusted.count()
        if now == n:
            return trusted, known
        n = now
        known = materialise(known.unionByName(pairs.join(_few(trusted), "pattern", "left_semi").select("instance")).distinct())


def count_words(scanned: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, n): the words of all texts that stand in each of ``patterns``, in one pass.

    Words in other patterns are one group more, without a pattern, so that what the join makes is two rows a word at most
    whatever patterns are counted.
    """
    listed = _few(patterns.select("pattern", F.col("pattern").alias("listed")))
    words = occurrences(scanned, words=False).where(instance_of(F.col("word")).isNotNull())
    # written with that group: a condition on the pattern would move below the join
    n = materialise(words.join(listed, "pattern", "left").groupBy("listed").agg(F.count("*").alias("n")))
    return patterns.select("pattern").join(n, F.col("pattern") == F.col("listed"), "left").select(
        "pattern", F.coalesce("n", F.lit(0)).alias("n"))


def discover(scanned: DataFrame, support: int = SUPPORT, specific: float = SPECIFIC, confidence: float = CONFIDENCE) -> DataFrame:
    """(row, i, instance) of the words that are no seeds and stand in a trusted pattern; ``scanned``: row, source, items."""
    seeds = occurrences(scanned.where(F.size("items") > 0)).where(is_seed(F.col("word"))).select(
        "pattern", instance_of(F.col("word")).alias("instance"))
    known_in = materialise(seeds.where("instance IS NOT NULL").groupBy("pattern", "instance").agg(F.count("*").alias("n")))
    known = materialise(known_in.select("instance").distinct())
    counts, looked, hits = None, None, None
    while True:
        # patterns of enough known instances, each counted in the texts once
        of = materialise(known_in.groupBy("pattern").agg(F.count("*").alias("k"), F.sum("n").alias("n_known"), F.sum(
            F.when(is_seed(F.col("instance")), F.col("n")).otherwise(0)).alias("n_seeds")).where(F.col("k") >= support).drop("k"))
        todo = of.select("pattern")
        todo = materialise(todo if counts is None else todo.join(counts, "pattern", "left_anti"))
        if not todo.isEmpty():
            new = count_words(scanned, todo)
            counts = materialise(new if counts is None else counts.unionByName(new))
        if counts is None:
            break
        # where all words are seeds there is nothing to find
        fit = of.join(counts, "pattern").where(
            (F.col("n_known") >= specific * F.col("n")) & (F.col("n") > F.col("n_seeds"))).select("pattern")
        fit = materialise(fit if looked is None else fit.join(looked, "pattern", "left_anti"))
        if fit.isEmpty():
            break
        looked = fit if looked is None else looked.unionByName(fit)
        found = occurrences(scanned).join(_few(fit), "pattern").where(~is_seed(F.col("word"))).select(
            "row", "i", "pattern", instance_of(F.col("word")).alias("instance")).where("instance IS NOT NULL")
        found = materialise(found)
        hits = found if hits is None else hits.unionByName(found)
        pairs = materialise(hits.select("pattern", "instance").unionByName(known_in.join(looked, "pattern", "left_semi").select(
            "pattern", "instance")).distinct())
        trusted, everything = settle(pairs, known, support, confidence)
        fresh = materialise(everything.join(known, "instance", "left_anti"))
        known = everything
        if fresh.isEmpty():
            break
        # the other patterns in which the new ones stand
        more = occurrences(scanned).withColumn("instance", instance_of(F.col("word"))).join(_few(fresh), "instance").groupBy(
            "pattern", "instance").agg(F.count("*").alias("n"))
        known_in = materialise(known_in.unionByName(more))
    if hits is None:
        return scanned.sparkSession.createDataFrame([], "row long, i int, instance string")
    return materialise(hits.join(_few(trusted), "pattern", "left_semi").select("row", "i", "instance").distinct())


def place(scanned: DataFrame, hits: DataFrame) -> DataFrame:
    """(row, found): the spans (start, end) of words given by their place in a text. Words and text have the same
    characters but for spaces, so a word is found by the number of those before it."""
    def bare(w: Column) -> Column:
        return F.when(is_seed(w), F.regexp_extract(w, f"x([0-9]+){CLOSE}", 1).cast("long")).otherwise(_solid(w))

    at = hits.groupBy("row").agg(F.collect_list(F.struct("i", "instance")).alias("hits"))
    source = scanned.select("row", "source", "items").join(_few(at), "row")
    texts = add_words(source).select("row", "words", running_sums(F.transform("words", bare)).alias("sums"))
    texts = texts.join(_few(at), "row")

    def ends(h: Column) -> Column:
        word, size = F.element_at("words", h["i"] + 1), _solid(h["instance"])
        lead = F.length(word) - F.length(F.ltrim(word, F.lit(LEADING)))
        first = F.element_at("sums", h["i"] + 1) - bare(word) + lead
        return F.struct(h["i"].alias("i"), first.alias("first"), (first + size - 1).alias("last"))

    hit = texts.select("row", F.explode(F.transform("hits", ends)).alias("h")).select("row", "h.*")
    hit = hit.select("row", "i", F.explode(F.array("first", "last")).alias("at"))
    run, body = rf"[^{SPACES}]+", F.col("source").cast("string")
    texts = source.select("row", F.regexp_extract_all(body, F.lit(run), F.lit(0)).alias("m"), F.split(body, run, -1).alias("p"))
    sizes = (F.transform("m", lambda x: F.length(x).cast("long")),
             F.transform(F.slice("p", F.lit(1), F.size("m")), lambda x: F.length(x).cast("long")))
    texts = texts.select("row", F.explode(F.arrays_zip(sizes[0].alias("n"), running_sums(sizes[0]).alias("to"),
                                                       running_sums(sizes[1]).alias("gap"))).alias("r"))
    begin = F.col("r.to") - F.col("r.n")
    runs = texts.select("row", F.lit(None).cast("int").alias("i"), begin.alias("at"), F.col("r.gap").alias("gap"))
    order = Window.partitionBy("row").orderBy("at", F.col("i").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = runs.unionByName(hit.withColumn("gap", F.lit(None).cast("long")))
    placed = both.select("row", "i", (F.col("at") + F.last("gap", ignorenulls=True).over(order)).alias("pos")).where("i IS NOT NULL")
    spans = placed.groupBy("row", "i").agg(F.min("pos").alias("start"), (F.max("pos") + 1).alias("end"))
    return spans.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("found"))


def find_personal_data(df: DataFrame, text: str = "text", keep: list[str] | None = None, **options) -> DataFrame:
    """Columns ``keep`` (default: all) plus ``base`` and ``spans``: arrays of (start, rank, kind, end).

    Positions are code points, the end exclusive; spans are sorted by start,
    then kind. ``base`` holds the fixed kinds, ``spans`` those and the
    discovered ones (kind ``context``). Null and empty texts have none. Rows
    that repeat are each returned; an empty table gives no rows; texts of any
    length are read whole; a kept column with the name of an output is replaced.
    ``options``: ``support``, ``specific`` and ``confidence`` of ``discover``.
    """
    inner = open_frame(df, keep, ("base", "spans"))
    src = inner.df.select(*inner.kept, F.col(inner.name(text)).alias("source"))
    scanned = add_occurrences(src, "source")
    scanned = materialise(scanned.withColumn("row", F.monotonically_increasing_id()))
    known = scanned.select("row", "source", "items")
    hits = discover(known, **options)
    # while the discovered spans are few they go to the texts, else the texts are shuffled
    found = _few(materialise(place(known, hits).withColumnRenamed("row", "at")))
    spans = F.transform("items", lambda x: F.struct(
        x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"), x["end"].alias("end")))
    out = scanned.withColumn("base", F.array_sort(spans)).drop("items", "source").join(found, F.col("row") == F.col("at"), "left")
    added = F.transform("found", lambda x: F.struct(x["start"].alias("start"), F.lit(len(KINDS)).alias("rank"),
                                                    F.lit(FOUND).alias("kind"), x["end"].alias("end")))
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    out = out.withColumn("spans", F.array_sort(F.concat("base", F.coalesce(added, none))))
    return inner.close(out, "base", "spans")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The contract's columns."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(doc_id, *[count(k) for k in KINDS], F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _written(F.col("spans")).alias("spans"))


def redact(body: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one, with the first's."""
    return replace_spans(body, spans, lambda s, begin, cut: F.when(begin == s["start"], F.concat(
        F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(""))


def redact_documents(df: DataFrame, text: str = "text", n_chars: str = "n_chars", **options) -> DataFrame:
    """All columns, the text without personal data (null stays null); ``n_chars`` is counted anew where there is one."""
    inner = open_frame(df)
    body = inner.name(text)
    out = find_personal_data(inner.df, body, **options)
    new = F.when(F.size("spans") > 0, redact(F.col(body).cast("string"), F.col("spans"))).otherwise(F.col(body))
    out = out.withColumn(body, new)
    if n_chars.lower() in [c.lower() for c in df.columns]:
        count = inner.name(n_chars)
        out = out.withColumn(count, F.when(F.size("spans") > 0, F.length(body).cast(inner.df.schema[count].dataType))
                             .otherwise(F.col(count)))
    return inner.close(out)
