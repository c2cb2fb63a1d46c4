"""The engine as one object: build the tables of exports, validate, add files, analyse
(survey §2.13, PIPE-17..19)."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeforge import reports
from citeforge.config import load
from citeforge.functions.text import blank, strip, text
from citeforge.operators import analytics, coverage, details, entities, matching, patents, quality
from citeforge.operators.ids import dense_ids, insert_or_replace, update_by_key
from citeforge.schemas import KEYS, conform
from citeforge.session import cut
from citeforge.sources import exports
from citeforge.sources.store import Store, new_files

ORDER = "record_id"


class Engine:
    """``Engine(spark, folder).build(paths)`` writes the tables; the rest reads them."""

    def __init__(self, spark: SparkSession, folder: str, config: str | None = None):
        self.spark, self.conf = spark, load(config)
        self.store = Store(spark, folder)
        #: Files that could not be read, with the error.
        self.failed: dict[str, str] = {}

    # --- building -----------------------------------------------------------------------

    def build(self, paths: list[str]) -> dict[str, int]:
        """Exports to tables; the number of rows of each. Files that fail are left out (``failed``)."""
        return self.build_from(exports.scan_all(self.spark, paths, failed=self.failed), len(paths) > 1)

    def build_from(self, raw: DataFrame, several_files: bool = True) -> dict[str, int]:
        """Bound records (with ``file_ord, src_ord``) to tables. Every table is one branch of the
        kept records, which are written once."""
        for name in self.store.tables():
            self.store.drop(name)
        self._append(raw, several_files)
        return self.store.counts()

    def _append(self, raw: DataFrame, dedup: bool) -> None:
        """Records that are new to the store, after those it holds: each table gets rows, none is
        rewritten. Ids go on where they end; keys that are known keep theirs."""
        raw = cut(raw if exports.BROKEN in raw.columns else raw.withColumn(exports.BROKEN, F.lit(None).cast("string")), "scanned")
        self._put("rejected_records", exports.rejects(raw))
        good = raw.filter(F.col(exports.BROKEN).isNull()).drop(exports.BROKEN)
        numbered = self._numbered(dense_ids(good, ["file_ord", "src_ord"], ORDER), "source_records", ORDER)
        before = self._old("source_records")
        unique = quality.dedup_by_doi(numbered, [ORDER]) if dedup else numbered
        if before is not None and dedup:
            known = before.select(strip(text("doi")).alias("__doi")).filter("__doi <> ''").distinct()
            unique = unique.withColumn("__doi", strip(text("doi"))).join(known, "__doi", "left_anti").drop("__doi")
        wanted = self.conf["data_quality"]
        flags = cut(quality.flagged(unique, wanted["strict"], wanted["enabled"], self._required()), "flags")
        kept = cut(flags.filter("reason is null").drop("reason", "category"), "kept")
        papers = cut(self._numbered(entities.papers(kept, ORDER), "papers", "paper_id"), "papers")
        masters = {
            "authors_master": (entities.authors(kept, ORDER), "author_id", "scopus_id"),
            "institutions_master": (entities.institutions(kept, ORDER), "institution_id", "canonical_name"),
            "keywords_master": (entities.keywords(kept, ORDER), "keyword_id", "normalized_text"),
        }
        known = {}
        for name, (rows, id_col, key) in masters.items():
            old = self._old(name)
            fresh = rows if old is None else rows.join(old.select(key), key, "left_anti")
            if old is not None:
                fresh = dense_ids(fresh.drop(id_col).join(rows.select(key, F.col(id_col).alias("__at")), key), ["__at"], id_col).drop("__at")
            fresh = cut(self._numbered(fresh.select(*rows.columns), name, id_col), name)
            known[name] = fresh if old is None else old.unionByName(fresh)
            self._put(name, fresh)
        bridges = {
            "paper_authors": (entities.paper_authors, "authors_master"), "paper_institutions": (entities.paper_institutions, "institutions_master"),
            "paper_keywords": (entities.paper_keywords, "keywords_master"),
        }
        for name, (make, master) in bridges.items():
            _, id_col, key = masters[master]
            self._put(name, conform(entities.with_ids(make(kept, ORDER), papers, ORDER, known[master], key, id_col), name))
        of_paper = papers.select(ORDER, "paper_id")
        for name, rows in {
            "paper_citations": details.references(kept, ORDER), "paper_funding": details.funding(kept, ORDER),
            "paper_chemicals": details.chemicals(kept, ORDER), "paper_trade_names": details.trade_names(kept, ORDER),
            "paper_correspondence": details.correspondences(kept, ORDER), "paper_open_access": details.access(kept, ORDER),
        }.items():
            self._put(name, conform(rows.join(of_paper, ORDER), name))
        self._put("exclusions", flags.filter("reason is not null"))
        self._put("records", kept)
        self._put("paper_records", of_paper)
        self._put("papers", conform(papers, "papers"))
        # Last, as it is what tells which files have been taken in.
        self._put("source_records", numbered)

    def _old(self, name: str) -> DataFrame | None:
        return self.store.read(name) if self.store.exists(name) else None

    def _put(self, name: str, df: DataFrame) -> None:
        old = self._old(name)
        if old is not None:
            # A later export may have columns that the earlier ones had not, and the other way round.
            df = df.select(*[F.col(c) for c in df.columns], *[F.lit(None).cast(t).alias(c) for c, t in old.dtypes if c not in df.columns])
        self.store.write(name, df, "append")

    def _numbered(self, df: DataFrame, name: str, id_col: str) -> DataFrame:
        """Ids 1..n moved behind the last one that the store holds."""
        old = self._old(name)
        last = (old.agg(F.max(id_col)).first()[0] or 0) if old is not None else 0
        return df.withColumn(id_col, (F.col(id_col) + last).cast("long")) if last else df

    def _required(self) -> list[str]:
        """The required fields that the settings do not switch off."""
        return [f for f in quality.REQUIRED_STRICT if self.conf["data_quality"].get(f"require_{f}", True)]

    def add(self, paths: list[str]) -> dict[str, int]:
        """[PIPE-18/19] Take in further exports: those of the manifest are left out, of the others
        the records with new DOIs are appended. A store of a single export, which is not
        de-duplicated, is built anew once."""
        if not self.store.exists("source_records"):
            return self.build(paths)
        listed = self.spark.createDataFrame([(p, p.rsplit("/", 1)[-1]) for p in paths], "path string, src_file string")
        held = self.store.read("source_records")
        files = held.select("src_file").distinct()
        # The list of paths was the caller's, so what is left of it fits the driver.
        todo = [r["path"] for r in new_files(listed, files).orderBy("path").collect()]
        if not todo:
            return self.info()
        last = held.agg(F.max("file_ord")).first()[0] or 0
        fresh = exports.scan_all(self.spark, todo, failed=self.failed).withColumn("file_ord", F.col("file_ord") + last + 1)
        if files.limit(2).count() == 1:
            return self.build_from(cut(held.drop(ORDER).unionByName(fresh, allowMissingColumns=True), "both"))
        self._append(fresh, True)
        return self.info()

    # --- enrichment ---------------------------------------------------------------------

    def recover_dois(self, works: DataFrame) -> dict:
        """[PIPE-14] Missing DOIs of the records from works that carry one, by the settings' thresholds;
        the counts by phase. The matches are kept in ``doi_recoveries``."""
        records = self.store.read("records")
        matched = self.store.write("doi_recoveries", matching.cascade(records, works, self.conf["crossref"]["thresholds"]))
        stats = reports.rows(matching.recovery_stats(records, matched))[0]
        if "doi" in works.columns:
            found = matched.join(works.select("work_id", "doi"), "work_id").filter(~blank("doi")).select(ORDER, "doi")
            blanked = records.withColumn("doi", F.when(~blank("doi"), F.col("doi")))
            self.store.replace("records", update_by_key(blanked, found, ORDER, ["doi"]))
            of_paper = self.store.read("paper_records").join(found, ORDER).select("paper_id", "doi")
            papers = self.store.read("papers").withColumn("doi", F.when(~blank("doi"), F.col("doi")))
            self.store.replace("papers", update_by_key(papers, of_paper, "paper_id", ["doi"]).withColumn("doi", text("doi")))
        return stats

    def link_patents(self, deliveries: DataFrame, resume: bool = False) -> dict:
        """[PIPE-15, AGG-26] Patents and their links to the papers, by the phases and thresholds of the
        settings. ``resume``: papers that have been linked before are left out."""
        pubs = self._publications()
        log = self._old("enrichment_log")
        if resume and log is not None:
            pubs = pubs.join(log.select(F.col("pub_id").alias("paper_id")), "paper_id", "left_anti")
        pubs = cut(pubs, "to-link")
        conf = self.conf["lens"]
        links = patents.link_all(pubs, deliveries, conf["phases"], "paper_id", conf["thresholds"])
        keys = {"patents": ["lens_id"], "publication_patent_links": ["pub_id", "lens_id", "link_type"]}
        for name, rows in (("patents", patents.patent_table(deliveries)), ("publication_patent_links", links)):
            old, fresh = self._old(name), cut(conform(rows, name), name)
            self.store.replace(name, fresh if old is None else insert_or_replace(old, fresh, keys[name], keys[name]))
        self.store.write("enrichment_log", pubs.select(F.col("paper_id").alias("pub_id"), F.current_timestamp().alias("done_at")), "append" if resume else "overwrite")
        t = self.store.read
        return reports.rows(analytics.enrichment_stats(t("publication_patent_links"), t("patents"), t("enrichment_log")))[0]

    def _publications(self) -> DataFrame:
        return self.store.read("records").join(self.store.read("paper_records"), ORDER)

    def _analysed(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        pubs = self._publications().select(
            F.col("paper_id").alias("pub_id"), "title", "authors", "author_keywords", "affiliations", coverage.valid_year().alias("year")
        )
        return pubs, self.store.read("publication_patent_links"), self.store.read("patents")

    def institution_patents(self, name: str) -> DataFrame:
        return analytics.institution_patents(*self._analysed(), name)

    def author_patents(self, name: str) -> DataFrame:
        return analytics.author_patents(*self._analysed(), name)

    def innovation(self) -> dict[str, DataFrame]:
        """Metrics, time lags, subjects and institutions over the linked patents."""
        pubs, links, pats = self._analysed()
        return {
            "metrics": analytics.innovation_metrics(pubs, links), "bands": analytics.confidence_histogram(links),
            **analytics.technology_transfer(pubs, links, pats), "institutions": analytics.institution_ranking(pubs, links, 20),
        }

    # --- checks and reports -------------------------------------------------------------

    def validate(self) -> list[dict]:
        """[VAL-16] The checks of the stored tables against the records they were made of."""
        t = self.store.read
        source = t("records")
        of_paper = t("papers").join(t("paper_records"), "paper_id")
        given = lambda *names: source.filter(F.greatest(*[(~blank(n)).cast("int") for n in names if n in source.columns], F.lit(0), F.lit(0)) > 0)
        tokens = entities.keyword_tokens(source, ORDER).groupBy("keyword_type").agg(F.countDistinct(ORDER, F.lower("keyword_text")).alias("n"))
        cited = lambda df: df.filter(F.col("cited_by").try_cast("int") > 0)
        return reports.rows(
            coverage.run_all([
                coverage.same_count("paper_count", t("papers"), source),
                coverage.same_content("paper_content", of_paper, source, ORDER, ["title", "doi", "abstract", "source_title"]),
                coverage.same_count("author_entries", t("paper_authors"), entities.paper_authors(source, ORDER)),
                coverage.first_author("first_author", t("paper_authors").join(t("paper_records"), "paper_id"), t("authors_master"), source, ORDER),
                coverage.near_counts("keywords", t("paper_keywords").groupBy("keyword_type").agg(F.count("*").alias("n")), tokens, "keyword_type"),
                coverage.same_count("cited_papers", cited(t("papers")), cited(source)),
                coverage.not_empty("institutions", t("paper_institutions"), given("affiliations")),
                coverage.not_empty("funding", t("paper_funding"), given("funding")),
                coverage.not_empty("chemicals", t("paper_chemicals"), given("chemicals")),
                coverage.not_empty("trade_names", t("paper_trade_names"), given("trade_names")),
                coverage.not_empty("references", t("paper_citations"), given("ref_list")),
                coverage.no_orphans("paper_authors", t("paper_authors"), t("papers"), "paper_id"),
                coverage.no_orphans("paper_keywords", t("paper_keywords"), t("papers"), "paper_id"),
                *[coverage.unique_key(f"{n}_key", t(n), k) for n, k in KEYS.items() if self.store.exists(n)],
                *[coverage.not_empty(n, t(n), source) for n in ("papers", "authors_master", "keywords_master", "institutions_master")],
                coverage.few_blank("titles", t("papers"), "title"),
                coverage.special_characters("special_characters", of_paper, source, ORDER),
            ])
        )

    def info(self) -> dict[str, int]:
        return self.store.counts()

    def sql(self, query: str) -> DataFrame:
        self.store.register_views()
        return self.spark.sql(query)

    def report(self, path: str, fmt: str = "json") -> None:
        records = self.store.read("source_records")
        parts = {
            "exclusions": quality.breakdown(records), "yearly": coverage.yearly_counts(self.store.read("records")),
            "completeness": coverage.completeness(records, ["title", "doi", "abstract", "authors"]),
        }
        reports.enrichment_summary(parts, path, fmt)

    def reports(self, folder: str) -> list[str]:
        """[SNK-09, PIPE-20] The reports, each a JSON file, and the records without DOI as CSV and text."""
        Path(folder).mkdir(parents=True, exist_ok=True)
        records = self.store.read("source_records")
        strict = self.conf["data_quality"]["strict"]
        summary = reports.exclusion_summary(records, strict)
        parts = {
            "exclusions": {"summary": summary, "advice": reports.recommendations(summary), "first": reports.first_rows(self.store.read("exclusions").select(ORDER, "reason", "title"), ORDER)},
            "duplicates": reports.first_rows(quality.duplicate_log(records, [ORDER], ORDER), ORDER, 100),
            "yearly": reports.rows(coverage.yearly_counts(self.store.read("records")).orderBy("year")),
            "validation": self.validate(), "rejected": reports.rows(self.store.read("rejected_records").groupBy("src_file", "reason").count()),
        }
        if self.store.exists("publication_patent_links"):
            parts["enrichment"] = {n: reports.rows(d) for n, d in self.innovation().items()}
        for name, value in parts.items():
            reports.write_json(f"{folder}/{name}.json", value)
        reports.missing_doi_report(records, folder)
        return sorted([*parts, "missing_doi"])
