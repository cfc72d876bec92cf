"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are combined per page: the likelihood of its text under
character trigram models, the language its markup declares, the suffix of its
address, and a prior of its host. Host priors are smoothed hierarchically:
a host leans on its domain, a domain on the whole corpus, each by its own
grouped counts. Declarations and suffixes count for what they are worth in
this corpus: their likelihoods come from the same counts of text posteriors.

Trigram counts come from a bounded sample of labelled texts (``TRAIN_ROWS``);
everything else is aggregated over all pages. Counts are sums of posteriors in
whole millionths, so they do not depend on the order of addition. A page's own
posterior is taken out of the counts it is judged by.

Defined results: a null or empty page has no text evidence and is judged by
the rest; a null address has an empty host, domain and suffix; no declaration
is a declaration of its own ('') with its own likelihoods; repeated rows are
judged alike; ties go to the language first in code point order; without
labelled texts the language is null; very long pages are read whole; an empty
table gives an empty result; other columns, also of the result's names, are not
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import RESERVED, written
from .url_filter import url_parts

#: Labelled texts that the trigram models are trained on (about).
TRAIN_ROWS = 20_000
#: Hashed trigrams a language has; added to each count.
BUCKETS, SMOOTHING = 1 << 14, 0.5
#: Weight of a trigram's evidence (neighbouring trigrams are not independent).
TEXT_WEIGHT = 0.3
#: Pseudo-pages with which a host leans on its domain, a domain on the corpus, a likelihood on the total.
STRENGTH = 10.0
MILLION = 1_000_000

_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;", re.S | re.I)
_DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)"


def visible(html: str) -> str:
    return _HIDDEN.sub(" ", html)


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the lower-cased text."""
    c = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    if len(c) < 3:
        return np.empty(0, dtype=np.int64)
    h = (c[:-2] * np.uint64(0x9E3779B1) ^ c[1:-1] * np.uint64(0x85EBCA77) ^ c[2:] * np.uint64(0xC2B2AE3D)) & np.uint64(0xFFFFFFFF)
    return ((h * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)) >> np.uint64(18)).astype(np.int64)


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [bucket, language]) from a bounded sample."""
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n, grain = usable.count(), 1 << 30
    share = int(grain * min(1.0, rows / n)) if n else 0
    sample = usable.where(F.pmod(F.xxhash64(key), F.lit(grain)) < share).select(lang, text)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                total.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                total[name] += np.bincount(trigrams(body.as_py()), minlength=BUCKETS)
        for name, counts in total.items():
            found = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(found)), pa.array(found), pa.array(counts[found])], names=["lang", "bucket", "n"])

    # At most BUCKETS rows a language reach the driver, however large the sample.
    counted = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    languages = sorted(counted["lang"].unique())
    table = np.full((BUCKETS, len(languages)), SMOOTHING)
    table[counted["bucket"], [languages.index(x) for x in counted["lang"]]] += counted["n"]
    return languages, np.log(table / table.sum(axis=0))


def text_scores(html: Column, model: np.ndarray) -> Column:
    """Weighted log-likelihood of the visible text in each language."""
    @F.pandas_udf("array<double>")
    def of(pages: pd.Series) -> pd.Series:
        return pd.Series([TEXT_WEIGHT * model[trigrams(visible(p or ""))].sum(axis=0) for p in pages], dtype=object)

    return of(html)


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    exps = [F.exp(x - top) for x in logs]
    return [e / sum(exps[1:], exps[0]) for e in exps]


def identify(pages: DataFrame, languages: list[str], model: np.ndarray, page_id: str = "page_id",
             url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, lang, probability, text_lang, declared, host): the most probable
    language of every page, and what its text alone says."""
    kind = pages.schema[page_id].dataType
    if not languages:
        return pages.select(page_id, *[F.lit(None).cast(t).alias(n) for n, t in (
            ("lang", "string"), ("probability", "double"), ("text_lang", "string"),
            ("declared", "string"), ("host", "string"))])
    each = range(len(languages))
    host = F.regexp_replace(url_parts(F.col(url))[0], r":\d*$", "")
    scored = pages.select(
        F.col(page_id).cast(kind).alias("id"), host.alias("host"),
        F.coalesce(F.lower(F.regexp_extract(F.col(html), _DECLARED, 1)), F.lit("")).alias("declared"),
        text_scores(F.col(html), model).alias("scores"))
    own = _softmax([F.col("scores")[k] for k in each])
    scored = written(scored.select("*", *[F.round(p * MILLION).cast("long").alias(f"p{k}") for k, p in enumerate(own)])
                     .withColumns({"domain": F.substring_index("host", ".", -2),
                                   "suffix": F.substring_index("host", ".", -1)}), "scored_pages")
    counts = lambda by, tag: written(scored.groupBy(*by).agg(
        *[F.sum(f"p{k}").alias(f"{tag}{k}") for k in each]), f"counts_{tag}")
    total = scored.agg(*[F.coalesce(F.sum(f"p{k}"), F.lit(0)).alias(f"g{k}") for k in each]).first()
    # Domain and suffix belong to the host: one table of hosts, one join of pages with it.
    hosts = written(counts(["host", "domain", "suffix"], "h")
                    .join(counts(["domain"], "d"), "domain").join(counts(["suffix"], "s"), "suffix")
                    .drop("domain", "suffix"), "hosts")
    rows = scored.join(hosts, "host").join(counts(["declared"], "c"), "declared")

    mine = [F.col(f"p{k}") for k in each]
    whole = [F.lit(total[f"g{k}"]) - mine[k] for k in each]
    everything = sum(whole[1:], whole[0])
    corpus = [(g + MILLION) / (everything + MILLION * len(languages)) for g in whole]

    def lean(tag: str, upper: list[Column]) -> list[Column]:
        """Counts without the page's own, leaning on the level above."""
        n = [F.col(f"{tag}{k}") - mine[k] for k in each]
        size = sum(n[1:], n[0])
        return [(n[k] + STRENGTH * MILLION * upper[k]) / (size + STRENGTH * MILLION) for k in each]

    def likelihood(tag: str) -> list[Column]:
        """P(value | language), leaning on the value's share of the corpus."""
        n = [F.col(f"{tag}{k}") - mine[k] for k in each]
        share = (sum(n[1:], n[0]) + MILLION) / (everything + 2 * MILLION)
        return [(n[k] + STRENGTH * MILLION * share) / (whole[k] + STRENGTH * MILLION) for k in each]

    prior, declared, suffix = lean("h", lean("d", corpus)), likelihood("c"), likelihood("s")
    logs = [F.col("scores")[k] + F.log(prior[k]) + F.log(declared[k]) + F.log(suffix[k]) for k in each]
    names = F.array(*map(F.lit, languages))
    fused = rows.select("id", "host", "declared", "scores", F.array(*logs).alias(f"{RESERVED}logs"))
    post = _softmax([F.col(f"{RESERVED}logs")[k] for k in each])
    best = lambda a: F.get(names, F.array_position(a, F.array_max(a)).cast("int") - 1)
    return fused.select(
        F.col("id").alias(page_id), best(F.col(f"{RESERVED}logs")).alias("lang"),
        (F.greatest(*post) if len(post) > 1 else post[0]).alias("probability"),
        F.when(F.array_max("scores") < 0, best(F.col("scores"))).alias("text_lang"), "declared", "host")
