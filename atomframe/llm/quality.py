"""Quality rules with risk-controlled thresholds.

Each document gets counts (words, symbols, repeated lines, words in repeated 3-word windows, upper-case letters) and
from them five shares. For every stratum (language; null is a stratum of its own) and rule, cutoffs are tested on the
labelled documents, the most lenient first, until the exact binomial test no longer rejects "this cutoff turns away
more than ``risk / number of rules`` of the good documents". Testing in that fixed order needs no correction within a
rule; over strata and rules the level is divided by their number (Bonferroni), so with probability ``1 - delta`` no
stratum loses more than ``risk`` of its good documents. Of the cutoffs that pass, the one that turns away most bad
documents is used, the most lenient of equals; where none passes or none helps, the rule is off.

Null text has no words. Documents without labels only get the verdict. Several labels for one document count as one,
good if any says so; null labels are ignored. Rows with equal ids are judged one by one. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from atomframe.llm.common import chunks, column, numbered, raw, saved

SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
#: Bytes that continue a code point.
INNER = bytes(range(128, 192))
#: Shares are compared in steps of 1 / STEPS.
STEPS = 200
RULES = {
    "symbols": "n_symbols / word_chars",
    "dup_lines": "n_dup_lines / n_lines",
    "repeats": "n_repeat_words / n_words",
    "upper": "n_upper / word_chars",
    "same_words": "1 - n_distinct / n_words",
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_distinct"]


def repeat_words(ids: np.ndarray, n_distinct: int) -> int:
    """Words inside 3-word windows that occur at least twice in ``ids``."""
    if len(ids) < 4:
        return 0
    if n_distinct < 1 << 21:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(ids[:-1] * n_distinct + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1] * n_distinct + ids[2:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    hit = np.flatnonzero(np.isin(keys, twice))
    inside = np.zeros(len(ids), dtype=bool)
    for k in range(3):
        inside[hit + k] = True
    return int(inside.sum())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        texts = raw(batch)
        numbers, distinct, lengths = numbered([x.split() for x in texts])
        ends = np.cumsum(lengths)
        rows = []
        for text, end, n in zip(texts, ends, lengths, strict=True):
            ids = numbers[end - n : end]
            lines = [x for x in text.split(b"\n") if x.strip()]
            rows.append((
                n,
                len(text.translate(None, SPACES + INNER)),
                len(text) - len(text.translate(None, SYMBOLS)),
                len(lines) - len(set(lines)),
                repeat_words(ids, len(distinct)),
                len(lines),
                len(text) - len(text.translate(None, UPPER)),
                len(set(ids.tolist())),
            ))
        table = np.array(rows, dtype=np.int64).reshape(-1, len(COUNTS))
        own = ["doc_id", "stratum", "text_key"]
        yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in own), *(pa.array(c) for c in table.T)], [*own, *COUNTS])


def text_counts(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, text_key (equal for equal texts), the counts, base_failed and the shares in steps, one array in the
    order of RULES."""
    text = F.col("text").cast("string")
    rows = docs.select("doc_id", text.alias("text"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"), F.xxhash64(text).alias("text_key"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    df = rows.mapInArrow(_counts, f"doc_id {kind}, stratum string, text_key long, " + ", ".join(f"{c} long" for c in COUNTS))
    shares = [F.expr(f"coalesce(cast(floor({STEPS} * ({x})) as int), 0)") for x in (e.replace(" / word_chars", " / nullif(word_chars, 0)").replace(" / n_lines", " / nullif(n_lines, 0)").replace(" / n_words", " / nullif(n_words, 0)") for e in RULES.values())]
    return df.withColumn("base_failed", F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")).withColumn("shares", F.array(*shares))


def binomial_cdf(most: int, n: int, p: float) -> np.ndarray:
    """P(X <= k) for X ~ Bin(n, p) and k = 0 .. most (at most n), exactly summed from the ratios of neighbouring terms."""
    j = np.arange(min(most, n), dtype=np.float64)
    logs = n * math.log1p(-p) + np.append(0.0, np.cumsum(np.log((n - j) / (j + 1)) + math.log(p) - math.log1p(-p)))
    return np.minimum(1.0, np.cumsum(np.exp(logs)))


def cutoff(share: np.ndarray, good: np.ndarray, bad: np.ndarray, risk: float, level: float) -> int | None:
    """The largest share that is still kept, in steps; None if no cutoff passes and helps."""
    total, best, most = int(good.sum()), None, 0
    if not total:
        return None
    cdf = binomial_cdf(int(risk * total), total, risk)
    for c in range(STEPS, -1, -1):
        lost = int(good[share > c].sum())
        if lost >= len(cdf) or cdf[lost] > level:
            break
        if (caught := int(bad[share > c].sum())) > most:
            best, most = c, caught
    return best


def calibrated(counts: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """Cutoffs as rows (stratum, rule number, cutoff) for the rules that are on."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
    once = counts.where("not base_failed").join(known, "doc_id").groupBy("stratum", "text_key").agg(F.max("good").alias("good"), F.first("shares").alias("shares"))
    held = once.select("stratum", "good", F.posexplode("shares").alias("rule", "share"))
    table = held.groupBy("stratum", "rule", "share").agg(F.count_if(F.col("good") > 0).alias("good"), F.count_if(F.col("good") <= 0).alias("bad"))
    strata = held.agg(F.countDistinct("stratum")).first()[0]
    level, each = delta / max(1, strata * len(RULES)), risk / len(RULES)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        c = cutoff(pdf["share"].to_numpy(), pdf["good"].to_numpy(), pdf["bad"].to_numpy(), each, level)
        return pd.DataFrame({"stratum": [pdf["stratum"].iloc[0]], "rule": [pdf["rule"].iloc[0]], "cutoff": [c]}).dropna().astype({"rule": "int32", "cutoff": "int32"})

    return table.groupBy("stratum", "rule").applyInPandas(fit, "stratum string, rule int, cutoff int")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """One row for each document: its counts, base_failed, the rules it breaks and kept."""
    counts = saved(text_counts(docs, stratum), "quality")
    rules = calibrated(counts, labels, **options).groupBy("stratum").agg(F.collect_list(F.struct("rule", "cutoff")).alias("rules"))
    broken = F.expr("array_sort(transform(filter(coalesce(rules, array()), r -> shares[r.rule] > r.cutoff), r -> r.rule))")
    out = counts.join(rules, "stratum", "left").withColumn("broken", broken)
    return out.withColumn("kept", F.expr("not base_failed and size(broken) = 0")).drop("rules")


def op10_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("broken").cast("string").alias("broken_rules"))


SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, coalesce(lang, '') as s, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
l as (select r, [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines from d),
g as (select r, i, [w[i], w[i + 1], w[i + 2]] as g from (select r, w, unnest(range(1, len(w) - 1)) as i from d where len(w) > 2)),
twice as (select r, g from g group by 1, 2 having count(*) > 1),
rep as (select r, count(distinct k) as n from (select g.r, unnest([i, i + 1, i + 2]) as k from g join twice using (r, g)) group by 1),
c as (select d.r, doc_id, text, s, len(w) as n_words, coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, len(lines) as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper, len(list_distinct(w)) as n_distinct
  from d join l using (r) left join rep using (r)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    [coalesce(floor(200 * x), 0)::int for x in [n_symbols / nullif(word_chars, 0)::double, n_dup_lines / nullif(n_lines, 0)::double, n_repeat_words / nullif(n_words, 0)::double, n_upper / nullif(word_chars, 0)::double, 1 - n_distinct / nullif(n_words, 0)::double]] as shares from c),
k as (select doc_id, max(quality) as good from labels where doc_id is not null and quality is not null group by 1),
t as (select s, text, max(good) > 0 as good, any_value(shares) as shares from f join k using (doc_id) where not base_failed group by s, text),
x as (select s, rule, shares[rule + 1] as share, good from t, range(0, 5) q(rule)),
y as (select s, rule, c, count(*) filter (good) as total, count(*) filter (good and share > c) as lost, count(*) filter (not good and share > c) as caught from x, range(0, 201) q(c) group by all),
z as (select s, rule, c, total, lost, caught, lost <= 0.01 * total as few, case when lost <= 0.01 * total then list_sum([exp(lgamma(total + 1) - lgamma(j + 1) - lgamma(total - j + 1) + j * ln(0.01) + (total - j) * ln(0.99)) for j in range(0, lost + 1)]) end as tail from y),
ok as (select *, total > 0 and few and tail <= 0.05 / greatest(1, 5 * (select count(distinct s) from t)) as pass from z),
v as (select * from ok where pass and c > (select coalesce(max(b.c), -1) from ok b where b.s = ok.s and b.rule = ok.rule and not b.pass)),
cut as (select s, rule, arg_max(c, (caught, c)) as cutoff from v where caught > 0 group by 1, 2),
b as (select f.r, string_agg(rule::varchar, ', ' order by rule) as rules from f join cut on cut.s = f.s and f.shares[rule + 1] > cutoff group by 1)
select doc_id, n_words::bigint as n_words, word_chars, n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed, not base_failed and rules is null as kept, '[' || coalesce(rules, '') || ']' as broken_rules
from f left join b using (r)
"""
