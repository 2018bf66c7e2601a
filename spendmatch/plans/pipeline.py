"""Mart pipeline: build every mart once, materialising what later marts reuse.

Marts form a DAG (M1 feeds M2, M3, M10; M3 feeds M4, M5, M11-M16; M6 feeds
M8 -> M9 ...).  Written as nested lazy DataFrames, every reuse re-expands the
whole upstream plan, so analysis, optimisation and execution all repeat.
:class:`SpendMarts` computes each reused intermediate once:

* ``keep="table"`` writes it as Parquet under the shared
  ``spark.checkpoint.dir`` and reads it back — lineage is cut, the copy
  survives executor loss, later reads prune columns;
* ``keep="cache"`` persists it (memory, spilling to disk) for the life of one
  query — the first consumer fills the cache, a lost block is recomputed from
  lineage; :meth:`release` drops the caches;
* ``keep="none"`` leaves every mart lazy.

:meth:`refresh` is the production run (S7): marts are written in dependency
order and every downstream mart reads the table just written, exactly as the
source's materialised tables read each other — no extra copies.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from spendmatch.plans import marts
from spendmatch.session import drop_table, materialize, materialize_bucketed
from spendmatch.sources import fixtures as fx
from spendmatch.sources.tables import refresh_mart


class SpendMarts:
    """All certified-spend marts over one set of inputs.

    ``vendors``, ``contracts`` and ``spend`` are DataFrames with the source
    columns (FIXTURES.md §1), or functions that give them, called when a mart
    first reads the input.  ``checkpoint=False`` keeps everything lazy
    (one plan per mart, nothing written).
    """

    def __init__(self, vendors: DataFrame, contracts: DataFrame, spend: DataFrame, keep: str = "table",
                 contract_mode: str = "literal", strip_suffix: bool = True, inputs_stored: bool = False):
        from pyspark import StorageLevel
        self._cached: list[DataFrame] = []
        self._tables: list[str] = []
        if keep == "table":
            self._keep = lambda df: materialize(df, made=self._tables)
            self._keep_by = lambda df, keys: materialize_bucketed(df, keys, self._buckets, made=self._tables)
        elif keep == "cache":
            def _cache(df):
                # fill the cache before any consumer runs: AQE starts independent
                # branches concurrently, and every branch that finds the cache
                # still empty would recompute the whole input
                df = df.persist(StorageLevel.MEMORY_AND_DISK_DESER)
                df.count()
                self._cached.append(df)
                return df
            self._keep = _cache
        elif keep == "none":
            self._keep = lambda df: df
        else:
            raise ValueError(f"unknown keep {keep!r}")
        if keep != "table":
            self._keep_by = lambda df, keys: self._keep(df)
        self._store = None if keep == "none" else self._keep   # for steps that need a stored table
        self._keep_input = (lambda df: df) if inputs_stored else self._keep
        self._keep_mart = self._keep
        self._inputs = {"vendors": vendors, "contracts": contracts, "agency_spend": spend}
        self.contract_mode = contract_mode
        self.strip_suffix = strip_suffix

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str, **kw) -> "SpendMarts":
        """Inputs derived from the TPC-H-style test tables (FIXTURES recipes),
        stored once per session like the synced source sheets they stand for."""
        if kw.get("keep", "table") != "none":
            # an input that no mart of a query reads is not built for it
            return cls(*[partial(fx.stored, spark, sf_dir, name) for name in ("vendors", "contracts", "agency_spend")],
                       inputs_stored=True, **kw)
        return cls(fx.vendors(spark, sf_dir), fx.contracts(spark, sf_dir), fx.agency_spend(spark, sf_dir), **kw)

    def release(self) -> None:
        """Drop the caches and written intermediates; frames that still read them are then void."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        for path in self._tables:
            drop_table(SparkSession.active(), path)
        self._tables.clear()

    # ---- inputs (each is read several times downstream)
    def _input(self, name: str) -> DataFrame:
        given = self._inputs[name]
        return self._keep_input(given() if callable(given) else given)

    @cached_property
    def vendors(self) -> DataFrame:
        return self._input("vendors")

    @cached_property
    def contracts(self) -> DataFrame:
        return self._input("contracts")

    @cached_property
    def spend(self) -> DataFrame:
        return self._input("agency_spend")

    @cached_property
    def contracts_norm(self) -> DataFrame:
        """Normalised contracts with canonical names, shared by M1 and M8: made in each scan of the stored contracts, not stored again."""
        return marts.contracts_norm(self.contracts, self.strip_suffix)

    # ---- contract side
    def _contract_weighted(self) -> DataFrame:
        """M1 with counts instead of copies: stored if M2 or M3 has read it, else for one reading."""
        if "contract_weighted" in self.__dict__:
            return self.contract_weighted
        if self.contract_mode == "literal":
            return marts.contract_cert_weighted(
                self.vendors, self.contracts, self.strip_suffix, self._store, self.contracts_norm)
        return marts.contract_cert(self.vendors, self.contracts, mode=self.contract_mode,
                                   strip_suffix=self.strip_suffix, keep=self._keep,
                                   normalized=self.contracts_norm)

    @cached_property
    def contract_weighted(self) -> DataFrame:
        """The stored form, which M2 and M3 read several times."""
        return self._keep(self._contract_weighted())

    @cached_property
    def contract_cert(self) -> DataFrame:                      # M1
        return marts.expand_copies(self._contract_weighted())

    @cached_property
    def contract_matches(self) -> marts.ContractMatches:
        return marts.contract_matches(self.vendors, self.contracts, self._store, self.strip_suffix, self.contracts_norm)

    def totals(self, version: int, subs_only: bool = False) -> DataFrame:
        """M2 or M3 for one reading, from the stored form of M1 if there is one, else from rows and matches apart."""
        apart = self.contract_mode == "literal" and self._store and "contract_weighted" not in self.__dict__
        return marts.contract_totals(self.contract_matches if apart else self.contract_weighted, version, self._store, subs_only)

    @cached_property
    def contract_totals_v1(self) -> DataFrame:                 # M2
        return self.totals(1)

    @cached_property
    def contract_totals(self) -> DataFrame:                    # M3
        return self._keep_mart(self.totals(2))

    def _sub_totals(self) -> DataFrame:
        """M3 for those that read its subcontractors once: the table if there is one, else their totals alone, not stored."""
        return self.contract_totals if "contract_totals" in self.__dict__ else self.totals(2, subs_only=True)

    def _total_ids(self) -> DataFrame:
        """M3 for those that read only ids and names of its groups: the table if there is one, else the rows that it groups."""
        return self.contract_totals if "contract_totals" in self.__dict__ else marts.contract_groups(self.contracts_norm)

    @cached_property
    def contract_subs(self) -> DataFrame:                      # M4
        return marts.contract_subs_cert_spend(self._sub_totals())

    @cached_property
    def contract_prime_summary(self) -> DataFrame:             # M5
        return self._keep_mart(marts.contract_prime_summary(self.contract_subs))

    # ---- agency side
    @cached_property
    def agency_cert(self) -> DataFrame:                        # M6
        return self._keep_mart(marts.agency_cert(self.vendors, self.spend, strip_suffix=self.strip_suffix))

    @cached_property
    def agency_cert_no_source(self) -> DataFrame:              # M7
        return self.agency_cert.drop("source")

    @cached_property
    def flags(self) -> DataFrame:                              # M8
        return self._keep_mart(marts.agency_cert_flags(self.agency_cert, self.contracts, strip_suffix=self.strip_suffix,
                                                  normalized=self.contracts_norm))

    @cached_property
    def prime_totals(self) -> DataFrame:                       # M9
        return self._keep_mart(marts.prime_totals(self.flags))

    @cached_property
    def certified_spend(self) -> DataFrame:                    # M10
        return marts.certified_spend(self.flags, self._contract_weighted(), strip_suffix=self.strip_suffix)

    def prime_with_subs(self, mode: str = "tax_then_name") -> DataFrame:   # M11-M14
        return marts.prime_with_subs(self.primes_canon, self.subs_canon, mode=mode)

    @cached_property
    def _buckets(self) -> int:
        """Buckets of the tables that M11-M14 join by name: a million totals in each, no fewer than there are cores."""
        return max(SparkSession.active().sparkContext.defaultParallelism, min(256, self._total_ids().count() // 1_000_000 + 1))

    @cached_property
    def primes_canon(self) -> DataFrame:
        return self._keep_by(marts.primes_canon(self.prime_totals), ["canon_prime_vendor", "canon_agency_name"])

    @cached_property
    def subs_canon(self) -> DataFrame:
        return self._keep_by(marts.subs_canon(self._sub_totals(), self._total_ids()), ["s_canon_prime", "s_canon_agency"])

    @cached_property
    def prime_cert_summary(self) -> DataFrame:                 # M15
        return self._keep_mart(marts.prime_cert_summary(self.prime_totals, self.contract_prime_summary,
                                                   self._total_ids()))

    @cached_property
    def unmatched_contract_primes(self) -> DataFrame:          # M16
        return marts.unmatched_contract_primes(self.contract_prime_summary, self._total_ids(), self.prime_totals)

    def agency_filter(self, excluded: list[str] | None = None) -> DataFrame:   # M17
        return marts.agency_filter(self.prime_cert_summary, excluded)

    # ---- sink
    MART_TABLES = {
        "contract_cert": "contract_cert", "contract_totals_v1": "contract_totals_v1",
        "contract_totals": "contract_totals", "unmatched_contract_primes": "unmatched_contract_primes",
        "contract_subs_with_cert_spend": "contract_subs", "contract_prime_summary": "contract_prime_summary",
        "agency_cert": "agency_cert", "agency_cert_flags": "flags", "prime_totals": "prime_totals",
        "certified_spend": "certified_spend", "prime_cert_summary": "prime_cert_summary",
    }

    # dependency levels: a table only reads tables of earlier levels, so the
    # marts of one level are independent Spark jobs
    REFRESH_LEVELS = [
        ["contract_cert", "agency_cert"],
        ["contract_totals_v1", "contract_totals", "agency_cert_flags"],
        ["contract_subs_with_cert_spend", "contract_prime_summary", "prime_totals", "certified_spend"],
        ["prime_cert_summary", "prime_with_subs_rows", "prime_with_subs_any_cert", "prime_with_subs_qualifying",
         "prime_with_subs_tax_then_name", "unmatched_contract_primes"],
        ["agency_filter"],
    ]

    def _builder(self, table: str):
        if table.startswith("prime_with_subs_"):
            return lambda: self.prime_with_subs(table[len("prime_with_subs_"):])
        if table == "agency_filter":
            return self.agency_filter
        attr = self.MART_TABLES.get(table, table)
        return lambda: getattr(self, attr)

    def refresh(self, out_dir: str, names: list[str] | None = None, parallel: int = 4) -> dict[str, str]:
        """Full refresh of the marts as Parquet tables under ``out_dir``.

        Each mart is written once; the attribute is then replaced by a scan of
        the written table, so downstream marts read the table (lineage cut at
        every mart, as with the source's materialised tables).  The marts of
        one dependency level are written as concurrent Spark jobs (up to
        ``parallel``), so small stages of one mart do not leave cores idle.
        """
        from concurrent.futures import ThreadPoolExecutor

        written: dict[str, str] = {}
        spark = SparkSession.active()
        self._keep_mart = lambda df: df      # the written mart tables are the reuse points
        # shared inputs first, on this thread (cached properties are not locked)
        _ = (self.vendors, self.contracts, self.spend, self.contracts_norm, self.contract_weighted)

        def run(table: str) -> tuple[str, str]:
            path = f"{out_dir.rstrip('/')}/{table}"
            refresh_mart(self._builder(table)(), path)
            attr = self.MART_TABLES.get(table)
            if attr is not None:
                self.__dict__[attr] = spark.read.parquet(path)
            return table, path

        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for level in self.REFRESH_LEVELS:
                todo = [t for t in level if not names or t in names]
                if any(t.startswith("prime_with_subs_") for t in todo):
                    _ = (self.primes_canon, self.subs_canon)
                for table, path in pool.map(run, todo):
                    written[table] = path
        return written
