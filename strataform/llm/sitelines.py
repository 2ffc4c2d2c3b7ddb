"""Lines repeated across one site's documents.

Every line is reduced to its letters.  The share of a domain's documents with a
line is compared with that of all documents outside the domain by a
log-likelihood ratio; the false discovery rate is held by the Benjamini-Hochberg
rule.  Significant excess lines that also meet two least frequencies are removed
from each document, whose other lines keep their positions.

Lines that several sites share mask each other, so sites found to have an excess
leave the outside of the others and the rest is compared again, until nothing
new is found.

Texts are never shuffled: lines travel as hashes, and the lines found come back
to the documents as one small set for each domain.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataform.runtime import BROADCAST_LIMIT_BYTES, Stored, hot_rows, lookup_join, store, trimmed

#: A line must stand in this many documents of a domain ...
LEAST_DOCUMENTS = 6
#: ... and in this share of the domain's documents having a text.
LEAST_SHARE = 0.1
#: Expected share of false discoveries among the lines found.
FALSE_DISCOVERY_RATE = 0.05
#: Documents with the mean frequency of the lines that stand for an outside where a corpus has none.
LONE_DOCUMENTS = 100.0
#: Ratios are counted in bins of this width up to the last one, which takes all larger ones.
_BIN, _BINS = 0.05, 4000


def line_keys(text: Column) -> Column:
    """The keys of a text's lines, by position; 0 for a line without letters."""
    bare = F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\n]+", ""), "\n")
    return F.transform(bare, lambda line: F.when(line == "", F.lit(0).cast("long")).otherwise(F.xxhash64(line)))


def clean_domain(col: Column) -> Column:
    """A domain in lower case without outer blanks and leading ``www.``; null if blank."""
    return F.nullif(F.regexp_replace(F.lower(trimmed(col)), r"^www\.", ""), F.lit(""))


def url_host(url: Column) -> Column:
    """The host of a URL without user and port; null where there is none."""
    return F.nullif(F.regexp_extract(trimmed(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def with_domain(documents: DataFrame, resources: DataFrame, url: str = "source_url") -> DataFrame:
    """Add each document's ``domain``: its resource's, or its URL's host.

    Of several resource rows for one URL the one seen last counts.
    """
    seen = F.struct(F.coalesce("last_seen_at", F.timestamp_micros(F.lit(0))), clean_domain(F.col("domain")))
    known = resources.where("url is not null").groupBy(F.col("url").alias(url)).agg(F.max(F.when(clean_domain(F.col("domain")).isNotNull(), seen)).alias("seen"))
    named = known.select(url, F.col("seen").getField("col2").alias("known_domain"))
    return documents.join(named, url, "left").withColumn("domain", F.coalesce("known_domain", clean_domain(url_host(F.col(url))))).drop("known_domain")


def _log_likelihood_ratio(k1: Column, n1: Column, k2: Column, n2: Column) -> Column:
    """Twice the log-likelihood ratio of two shares against a common one; 0 unless the first is larger."""
    both = (k1 + k2) / (n1 + n2)

    def term(k: Column, n: Column) -> Column:
        has = F.when(k > 0, k * F.log(k / (n * both))).otherwise(0.0)
        lacks = F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - both)))).otherwise(0.0)
        return has + lacks

    return F.when(k1 / n1 > k2 / n2, 2 * (term(k1, n1) + term(k2, n2))).otherwise(0.0)


def _least_ratio(counted: list[tuple[int, int]], rate: float) -> int | None:
    """The lowest bin that the Benjamini-Hochberg rule takes; ``counted`` holds each bin with its lines.

    The p-value of a ratio is the chi-square tail with one degree of freedom, a
    falling function of it, so the step-up rule needs counts and no sort.
    """
    total, above, least = sum(m for _, m in counted), 0, None
    for at, m in sorted(counted, reverse=True):
        above += m
        if math.erfc(math.sqrt(at * _BIN / 2)) <= rate * above / total:
            least = at
    return least


def _excess(tested: Stored, everything: int, mean_share: float, rate: float) -> Stored:
    """Judge each tested line of each site; see ``SiteLines.report``.

    A first round compares with all documents outside the site.  Later ones
    leave out sites found to have an excess of the same line.  Each round finds
    a line more or is the last.
    """
    judged, known = None, -1
    while True:
        if judged is None:
            rows = tested.df.withColumn("significant", F.lit(False)).withColumn("taken_n", F.lit(0).cast("long")).withColumn("taken_docs", F.lit(0).cast("long"))
        else:
            before = judged.df
            taken = before.where("significant").groupBy("line").agg(F.sum("n").alias("taken_n"), F.sum("site_docs").alias("taken_docs"))
            rows = before.select(*tested.df.columns, "significant", F.struct("outside_n", "outside_docs", "ratio").alias("decided")).join(taken, "line", "left").fillna(0, ["taken_n", "taken_docs"])
        outside_n = F.col("all_n") - F.col("n") - F.col("taken_n")
        outside_docs = F.lit(everything) - F.col("site_docs") - F.col("taken_docs")
        alone = outside_docs <= 0
        seen, size = F.when(alone, LONE_DOCUMENTS * mean_share).otherwise(outside_n.cast("double")), F.when(alone, LONE_DOCUMENTS).otherwise(outside_docs.cast("double"))
        ratio = _log_likelihood_ratio(F.col("n").cast("double"), F.col("site_docs").cast("double"), seen, size)
        fresh = F.struct(outside_n.alias("outside_n"), outside_docs.alias("outside_docs"), ratio.alias("ratio"))
        # A line found keeps the comparison that found it.
        rows = rows.withColumn("now", F.when(F.col("significant"), F.col("decided")).otherwise(fresh) if judged is not None else fresh)
        compared = store(rows.select(*tested.df.columns, "significant", "now.*"), "line-compared")
        step = F.least(F.lit(_BINS), F.floor(F.col("ratio") / _BIN)).cast("int")
        bins = [(r.step, r.m) for r in compared.df.groupBy(step.alias("step")).agg(F.count("*").alias("m")).collect()]
        least = _least_ratio(bins, rate)
        over = F.lit(False) if least is None else step >= least
        following = store(compared.df.withColumn("significant", F.col("significant") | over), "line-verdicts")
        compared.drop()
        if judged is not None:
            judged.drop()
        judged = following
        state = judged.df.agg(F.count_if("significant").alias("found"), F.count("*").alias("all")).first()
        if state.found in (known, 0, state.all):
            return judged
        known = state.found


class SiteLines:
    """The excess lines of ``documents(id, source_url, normalized_text)``.

    Each id counts once; of rows that share an id, the first in the order of
    their URL and lines counts.  Documents without id are left as they are, and
    those without a domain form no site.  Null texts have no lines.

    Tested are lines in ``least_documents`` documents of a site or more.
    """

    def __init__(self, documents: DataFrame, resources: DataFrame, least_documents: int = LEAST_DOCUMENTS, least_share: float = LEAST_SHARE, rate: float = FALSE_DISCOVERY_RATE):
        self.documents, self.resources = documents, resources
        narrow = documents.where("id is not null and normalized_text is not null").select("id", "source_url", line_keys(F.col("normalized_text")).alias("lines"))
        once = narrow.groupBy("id").agg(F.min(F.struct("source_url", "lines")).alias("r")).select("id", "r.*")
        self.lines: Stored = store(with_domain(once, resources).where("domain is not null").select("id", F.xxhash64("domain").alias("site"), "lines"), "site-lines")
        docs = self.lines.df
        sites = docs.groupBy("site").agg(F.count("*").alias("site_docs"))
        each = docs.select("site", F.explode(F.array_distinct("lines")).alias("line")).where("line <> 0")
        counts = store(each.groupBy("site", "line").agg(F.count("*").alias("n")), "line-counts")
        whole = counts.df.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("lines")).first()
        everything = docs.count()
        often = store(counts.df.where(F.col("n") >= least_documents).join(sites, "site"), "line-often")
        wanted = often.df.select("line").distinct()
        if often.size_bytes() <= BROADCAST_LIMIT_BYTES // 4:
            wanted = F.broadcast(wanted)
        overall = counts.df.join(wanted, "line", "left_semi").groupBy("line").agg(F.sum("n").alias("all_n"))
        frequent = (F.col("n") >= least_documents) & (F.col("n") / F.col("site_docs") >= least_share)
        self.tested = store(often.df.join(overall, "line").withColumn("frequent", frequent), "line-tests")
        counts.drop()
        often.drop()
        self.verdicts = _excess(self.tested, everything, whole.n / max(1, whole.lines * everything), rate)
        self.found = store(self.verdicts.df.where("significant and frequent").select("site", "line"), "site-found")

    def report(self) -> DataFrame:
        """``(site, line, n, site_docs, outside_n, outside_docs, ratio, significant, frequent)`` of every line tested.

        The outside is that of the round that decided the line.
        """
        return self.verdicts.df

    def _flagged(self) -> DataFrame:
        """``(site, flagged)``: the keys of a site's excess lines.

        Each stands in a tenth of the site's documents, so they are at most ten
        times the distinct lines of its average document.
        """
        return self.found.df.groupBy("site").agg(F.collect_set("line").alias("flagged"))

    def _by_site(self, rows: DataFrame, how: str) -> DataFrame:
        """Join documents to their site's set; large sites are kept from the shuffle."""
        if self.found.size_bytes() * 4 <= BROADCAST_LIMIT_BYTES:
            return rows.join(F.broadcast(self._flagged()), "site", how)
        flagged = store(self._flagged(), "flagged").df
        sites = store(self.lines.df.groupBy("site").agg(F.count("*").alias("n")), "sites").df
        hot = flagged.join(F.broadcast(hot_rows(sites, "n", self.lines.df.count()).select("site")), "site", "left_semi")
        return lookup_join(rows, "site", flagged, "site", hot, how)

    def occurrences(self) -> DataFrame:
        """``(id, line_no, site)`` of every excess line, lines counted from 1."""
        placed = self._by_site(self.lines.df, "inner").select("id", "site", "flagged", F.posexplode("lines").alias("at", "line"))
        return placed.where(F.array_contains("flagged", F.col("line"))).select("id", (F.col("at") + 1).cast("long").alias("line_no"), "site")

    def cleaned(self) -> DataFrame:
        """``(id, domain, normalized_text, removed_lines)`` for every row of the documents.

        Repeated rows stay repeated.  A text loses its site's excess lines; the
        others keep their order.
        """
        rows = with_domain(self.documents.select("id", "source_url", "normalized_text"), self.resources).withColumn("site", F.xxhash64("domain"))
        joined = self._by_site(rows, "left").withColumn("parts", F.split("normalized_text", "\n"))
        keys = line_keys(F.col("normalized_text"))
        kept = F.filter(F.arrays_zip(F.col("parts"), keys.alias("keys")), lambda x: ~F.array_contains("flagged", x["keys"]))
        touched = F.col("flagged").isNotNull() & F.col("normalized_text").isNotNull() & F.col("id").isNotNull()
        with_kept = joined.withColumn("kept", F.when(touched, kept["parts"]))
        return with_kept.select(
            "id",
            "domain",
            F.when(touched, F.array_join("kept", "\n")).otherwise(F.col("normalized_text")).alias("normalized_text"),
            F.when(touched, F.size("parts") - F.size("kept")).otherwise(0).cast("long").alias("removed_lines"),
        )


def domain_lines(found: DataFrame) -> DataFrame:
    """How many lines and occurrences each site loses."""
    return found.groupBy("site").agg(F.count("*").alias("occurrences"), F.countDistinct("id").alias("documents"))

