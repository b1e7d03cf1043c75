"""Operator 5: language identification of web pages by Bayesian evidence fusion.

For a page, log-posteriors over the languages of the training documents sum four sources of evidence:

* text: naive-Bayes log-likelihood of the visible text's character trigrams, hashed to ``BUCKETS``, counted over all
  documents per language. Trigrams of one text aren't independent, so the sum is tempered to the weight of at most ``MAX_TRIGRAMS``;
* the language declared in the markup (``lang`` of the html element): P(declared | language);
* the address suffix (top-level domain and a two-letter first path segment): P(suffix | language);
* the host: P(language | host), smoothed with its registered domain, which is smoothed with all pages.

The last three are counted by grouped aggregation over all pages, each page counted with its text's posterior, so no page's
declaration is believed more than declarations agree with texts elsewhere.

Edge cases: NULL html, or pages without visible text, are judged by the other evidence; a NULL or unusable url has the empty host and
suffix; documents without a language or text aren't trained on; without any training document ``lang`` and ``posterior`` are NULL;
ties go to the first language in code-point order; repeated rows get equal results; an empty table gives an empty result.
Every language label is modelled; the model has ``BUCKETS`` floats (128 KB) a label, and every task holds it.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, mix64, read_table, text_slices
from .trigrams import Accumulator, counted

BUCKETS = 1 << 15
ALPHA = 0.1                 # added to every bucket's count
MAX_TRIGRAMS = 100          # weight of a long text, in trigrams
STRENGTH = 5.0              # pages' worth of the wider group in the smoothing of hosts, declarations and suffixes

_HIDDEN = re.compile(r"<!--.*?-->|<(script|style|nav|noscript|template)\b.*?</\1\s*>", re.IGNORECASE | re.DOTALL)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"<html\b[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})\b", re.IGNORECASE)


def visible_text(page: str | None) -> str:
    return markup.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page or "")))


def declared_language(page: str | None) -> str:
    found = _DECLARED.search(page or "")
    return found[1].lower() if found else ""


def address(url: str | None) -> tuple[str, str, str]:
    """(host, registered domain, suffix) of an address; the registered domain is taken to be the last two labels."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").rstrip(".")
        first = parts.path.split("/")[1].lower() if parts.path.startswith("/") else ""
    except ValueError:
        return "", "", ""
    labels = host.split(".")
    suffix = labels[-1] if len(labels) > 1 else ""
    return host, ".".join(labels[-2:]), f"{suffix}/{first if re.fullmatch('[a-z]{2}', first) else ''}"


def _bucket(ids: np.ndarray) -> np.ndarray:
    return (mix64(ids.astype(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = Accumulator()
    for whole in batches:
        for b in text_slices(whole, "text", 1 << 20):
            langs, texts = b.column("lang").to_pylist(), b.column("text").to_pylist()
            for lang in set(langs):
                ids, _, n = counted([t.lower() for t, x in zip(texts, langs) if x == lang])
                total.add(lang, _bucket(ids), n)
    yield total.drain()


class Model:
    """Log-probabilities of the trigram buckets: one row per language, in code-point order."""

    def __init__(self, langs: list[str], counts: np.ndarray, documents: np.ndarray):
        self.langs = langs
        p = counts + ALPHA
        self.logp = np.log(p / p.sum(axis=1, keepdims=True)).astype(np.float32)
        self.prior = np.log((documents + 1.0) / (documents.sum() + len(langs)))


def train(documents: DataFrame) -> Model | None:
    """Model from all documents with a language; what reaches the driver is bounded by languages and buckets."""
    bounded_batches(documents.sparkSession)
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    counts = rows.mapInArrow(_train, "lang string, gram long, m long") \
        .groupBy("lang", "gram").agg(F.sum("m").alias("m"))
    langs = sorted(sizes)
    table = np.zeros((len(langs), BUCKETS))
    place = {x: i for i, x in enumerate(langs)}
    got = counts.toArrow()
    np.add.at(table, ([place[x] for x in got.column("lang").to_pylist()], got.column("gram").to_numpy()),
              got.column("m").to_numpy())
    return Model(langs, table, np.array([sizes[x] for x in langs], dtype=np.float64))


def _normalised(logp: np.ndarray) -> np.ndarray:
    p = np.exp(logp - logp.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def _evidence(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_slices(whole, "html", 1 << 20):
                pages = b.column("html").to_pylist()
                ids, doc, n = counted([visible_text(x).lower() for x in pages])
                score = np.zeros((len(pages), len(model.langs)))
                size = np.bincount(doc, weights=n, minlength=len(pages))
                for i, row in enumerate(model.logp):
                    score[:, i] = np.bincount(doc, weights=n * row[_bucket(ids)], minlength=len(pages))
                score *= (np.minimum(size, MAX_TRIGRAMS) / np.maximum(size, 1))[:, None]
                where = [address(u) for u in b.column("url").to_pylist()]
                own = _normalised(score + model.prior)
                yield pa.RecordBatch.from_arrays([
                    b.column("page_id"), *(pa.array([w[i] for w in where], pa.string()) for i in range(3)),
                    pa.array([declared_language(x) for x in pages], pa.string()),
                    pa.array(list(score), pa.list_(pa.float64())), pa.array(list(own), pa.list_(pa.float64()))],
                    names=["page_id", "host", "domain", "suffix", "declared", "text", "own"])
    return run


def _sums(n: int):
    """Aggregate: elementwise sum of the text posteriors (length n)."""
    return F.array(*[F.sum(F.col("own")[i]) for i in range(n)])


def identify(pages: DataFrame, model: Model | None) -> DataFrame:
    """(page_id, lang, posterior, text_lang, declared, host) per page."""
    spark = pages.sparkSession
    bounded_batches(spark)
    kind = dict(pages.dtypes)["page_id"]
    if model is None:
        where = F.lit(None)
        return pages.select("page_id", where.cast("string").alias("lang"), where.cast("double").alias("posterior"),
                            where.cast("string").alias("text_lang"), F.lit("").alias("declared"), F.lit("").alias("host"))
    n = len(model.langs)
    rows = materialise(pages.select("page_id", "url", "html").mapInArrow(
        _evidence(model), f"page_id {kind}, host string, domain string, suffix string, declared string, "
                          "text array<double>, own array<double>"), "page_evidence")
    every = rows.agg(_sums(n).alias("a")).first()["a"]
    total = np.array([x or 0.0 for x in every]) + 1.0
    overall = total / total.sum()

    def shares(by: str, wider) -> DataFrame:
        """P(language | ``by``) with :data:`STRENGTH` pages of the wider shares."""
        sums = rows.groupBy(by).agg(_sums(n).alias("_n"))
        return sums, [((F.col("_n")[i] + STRENGTH * wider(i)) / (sum(F.col("_n")[j] for j in range(n)) + STRENGTH))
                      for i in range(n)]

    sums, p = shares("domain", lambda i: F.lit(float(overall[i])))
    domains = materialise(sums.select("domain", F.array(*p).alias("domain_p")), "domain_priors")
    host = rows.groupBy("host", "domain").agg(_sums(n).alias("_n")).join(domains, "domain")
    count = sum(F.col("_n")[j] for j in range(n))
    hosts = materialise(host.select("host", "domain", F.array(*[
        (F.col("_n")[i] + STRENGTH * F.col("domain_p")[i]) / (count + STRENGTH) for i in range(n)]).alias("host_p")), "host_priors")

    def given(by: str) -> DataFrame:
        """P(value of ``by`` | language), smoothed with the value's share of all pages."""
        sums = rows.groupBy(by).agg(_sums(n).alias("_n"), F.count(F.lit(1)).alias("_m"))
        size = rows.count()
        return materialise(sums.select(by, F.array(*[
            (F.col("_n")[i] + STRENGTH * F.col("_m") / size) / F.lit(float(total[i] - 1.0 + STRENGTH)) for i in range(n)])
            .alias(f"{by}_p")), f"{by}_shares")

    joined = rows.join(hosts, ["host", "domain"]).join(given("declared"), "declared").join(given("suffix"), "suffix")
    fused = F.array(*[F.col("text")[i] + F.log(F.col("host_p")[i]) + F.log(F.col("declared_p")[i]) + F.log(F.col("suffix_p")[i])
                      for i in range(n)])
    joined = joined.withColumn("_f", fused).withColumn("_best", F.array_max("_f"))
    names = F.array(*[F.lit(x) for x in model.langs])
    posterior = F.lit(1.0) / sum((F.exp(F.col("_f")[i] - F.col("_best")) for i in range(n)), F.lit(0.0))
    return joined.select("page_id", F.get(names, (F.array_position("_f", F.col("_best")) - 1).cast("int")).alias("lang"),
                         posterior.alias("posterior"),
                         F.get(names, (F.array_position("own", F.array_max("own")) - 1).cast("int")).alias("text_lang"),
                         "declared", "host")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "pages"), train(read_table(spark, sf_dir, "documents")))
