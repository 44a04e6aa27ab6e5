"""URL filter: host/path rules first, then a weighted vocabulary matched by an Aho-Corasick automaton.

Rules win over the vocabulary. Without a fitting rule a URL is blocked on one
strict term, or once the weights of its *distinct* soft terms reach
``SOFT_LIMIT``. A term counts only where it is not part of a longer run of
letters and digits (``essex`` holds no ``sex``).

The automaton is built once per task from the fixed vocabulary, so the job is
one map over the URL column: no shuffle, and nothing that grows with the data
is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hedonic.llm.frames import open_frame

# Rules (host, path, verdict) of the contract.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

# One strict term rejects; soft terms add their weight once each.
STRICT = ["casino", "cheap-pills", "escort", "jackpot", "malware", "phishing", "porn", "spam-farm", "viagra", "xxx"]
SOFT = {"adult": 1, "bet": 1, "bonus": 1, "buy": 1, "cheap": 1, "coupon": 1, "dating": 1, "deal": 1, "free": 1,
        "hot": 1, "loan": 1, "pills": 1, "poker": 1, "promo": 1, "sex": 1, "spam": 1, "win": 1}
SOFT_LIMIT = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ALNUM = frozenset(LOWER + "0123456789")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lowered; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule whose host equals or is a parent domain of ``host``
    and whose path begins ``path``; both null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def build_automaton(strict=STRICT, soft=SOFT) -> ahocorasick.Automaton:
    auto = ahocorasick.Automaton()
    for t in sorted({*strict, *soft}):
        auto.add_word(t, t)
    auto.make_automaton()
    return auto


def count_terms(auto: ahocorasick.Automaton, url: str, strict: frozenset, soft: dict) -> tuple[int, int, int]:
    """Distinct strict terms, distinct soft terms and the soft weight standing alone in a lowered URL."""
    found = set()
    last = len(url) - 1
    for at, term in auto.iter(url):
        before = at - len(term)
        if (before < 0 or url[before] not in _ALNUM) and (at == last or url[at + 1] not in _ALNUM):
            found.add(term)
    hits = [t for t in found if t in soft and t not in strict]
    return sum(t in strict for t in found), len(hits), sum(soft[t] for t in hits)


def filter_urls(df: DataFrame, url: str = "url", rules=RULES, strict=STRICT, soft=SOFT,
                soft_limit: int = SOFT_LIMIT, keep: list[str] | None = None) -> DataFrame:
    """Judge every row's URL.

    Returns the columns ``keep`` (default: all) plus ``host, path, rule,
    verdict, n_strict, n_soft, soft_weight``; a kept column of one of these
    names is replaced. Null or empty URLs, and those without ``://``, have an
    empty host and path, no rule, and are judged by the vocabulary (null: no
    terms, so ``allow``). Rows that repeat are judged each; an empty table
    gives an empty table. URLs of any length are read whole.
    """
    outputs = ("host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")
    inner = open_frame(df, keep, outputs)
    raw = F.col(inner.name(url)).cast("string")
    src = inner.df.select(*inner.kept, raw.alias("url"), F.translate(raw, UPPER, LOWER).alias("low"))
    words, weights = frozenset(strict), dict(soft)

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = build_automaton(words, weights)
        for part in parts:
            counts = [(0, 0, 0) if u is None else count_terms(auto, u, words, weights)
                      for u in part.column("low").to_pylist()]
            cols = [pa.array([c[k] for c in counts], pa.int32()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*part.columns, *cols], names=[*part.schema.names, *outputs[4:]])

    out = src.mapInArrow(scan, T.StructType([*src.schema, *[T.StructField(c, T.IntegerType()) for c in outputs[4:]]]))
    out = out.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    by_terms = F.when((F.col("n_strict") > 0) | (F.col("soft_weight") >= soft_limit), "block").otherwise("allow")
    out = out.withColumn("rule", rule).withColumn("verdict", F.coalesce(verdict, by_terms))
    return inner.close(out, *outputs)


def _term_sql(terms) -> str:
    hit = "CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){}($|[^a-z0-9])') THEN {} ELSE 0 END"
    return " + ".join(hit.format(t, w) for t, w in terms)


def oracle_sql() -> str:
    """The contract's rows in DuckDB SQL, terms as bounded regular expressions."""
    fits = "((host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"WHEN {fits.format(h=h, p=p)} THEN '{h + p}'" for h, p, _ in longest)
    verdict = " ".join(f"WHEN {fits.format(h=h, p=p)} THEN '{v}'" for h, p, v in longest)
    return f"""
WITH u AS (SELECT page_id, url, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low FROM pages),
p AS (SELECT page_id, low,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM u),
t AS (SELECT *, ({_term_sql([(s, 1) for s in STRICT])}) AS n_strict,
        ({_term_sql([(s, 1) for s in SOFT])}) AS n_soft,
        ({_term_sql(SOFT.items())}) AS soft_weight FROM p)
SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule,
  CASE {verdict} WHEN n_strict > 0 OR soft_weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  n_strict, n_soft, soft_weight FROM t
"""
