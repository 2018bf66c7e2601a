"""Certified-spend marts composed from DataFrame operators.

Each function takes DataFrames and returns a lazy DataFrame; Catalyst plans
the whole chain.  The dependency graph is::

    vendors ─┬─► M1 contract_cert ─┬─► M2 totals_v1
    contracts┘                     └─► M3 totals_v2 ─► M4 subs_cert_spend ─► M5 prime_summary
    vendors ─┬─► M6 agency_cert ─► M8 flags ─┬─► M9 prime_totals ─► M11-M16 ─► M17
    spend ───┘        (contracts)            └─► M10 certified_spend (+ M1)

Money columns leave every mart as ``decimal(38,2)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendmatch.functions.text import (
    PRIME_TYPES, SUB_TYPES, blank_to_null, canon_name_a, canon_name_b, certified_spend_any,
    certified_spend_floor, certified_spend_qualifying, is_qualifying, is_sub_type, money, norm_label)
from spendmatch.operators.groups import find_shared, split_shared
from spendmatch.operators.matching import Step, UNMATCHED, best_vendor, cascade, spread
from spendmatch.session import bounded_broadcast

# The agencies left out of the published summary (M17), as listed
# by the source system, in its order.
EXCLUDED_AGENCIES = [
    "Arts Commission",
    "Board of Industrial Insurance Appeals",
    "Board of Tax Appeals",
    "Center for Childhood Deaf and Hard of Hearing Youth",
    "Commission on African American Affairs",
    "Commission on Asian Pacific American Affairs",
    "Commission on Hispanic Affairs",
    "County Road Administration Board",
    "Criminal Justice Training Commission",
    "Department of Agriculture",
    "Department of Archaeology and Historic Preservation",
    "Department of Children, Youth and Families",
    "Department of Commerce",
    "Department of Corrections",
    "Department of Ecology",
    "Department of Enterprise Services",
    "Department of Financial Institutions",
    "Department of Fish and Wildlife",
    "Department of Health",
    "Department of Labor and Industries",
    "Department of Licensing",
    "Department of Natural Resources",
    "Department of Retirement Systems",
    "Department of Revenue",
    "Department of Social and Health Services",
    "Department of Transportation",
    "Department of Veteran's Affairs",
    "Employment Security Department",
    "Energy Facility Site Evaluation Council",
    "Environmental and Land Use Hearings Office",
    "Gambling Commission",
    "Governor's Office of Indian Affairs",
    "Health Care Authority",
    "Horse Racing Commission",
    "Human Rights Commission",
    "Liquor and Cannabis Board",
    "Lottery Commission",
    "Military Department",
    "Office of Administrative Hearings",
    "Office of Financial Management",
    "Office of Independent Investigations",
    "Office of Minority and Women's Business Enterprises",
    "Office of the Attorney General",
    "Office of the Governor",
    "Office of the Insurance Commissioner",
    "Office of the Secretary of State",
    "Office of the State Treasurer",
    "Parks and Recreation Commission",
    "Public Disclosure Commission",
    "Public Employment Relations Commission",
    "Puget Sound Partnership",
    "Recreation and Conservation Funding Board",
    "Services for the Blind",
    "Office of the State Auditor",
    "State Board of Accountancy",
    "State Conservation Commission",
    "Superintendent of Public Instruction",
    "Traffic Safety Commission",
    "Transportation Improvement Board",
    "Utilities and Transportation Commission/Transportation Commission",
    "Pollution Liability Insurance Agency",
    "Washington State Patrol",
    "Washington State School for the Blind",
    "Washington Student Achievement Council",
    "Washington Technology Services",
    "Workforce Training and Education Coordinating Board",
]

PRIME_LABEL = "PRIME"
SUB_LABEL = "SUBCONTRACTOR"


# ----------------------------------------------------------------------- M1
CONTRACT_KEY4 = ["business_name", "contract_holder", "amount_paid", "audit_period"]


def contracts_norm(contracts: DataFrame, strip_suffix: bool = True) -> DataFrame:
    """Contract rows with normalised ids/labels and the canonical business name.

    Computed once and shared by M1 and M8 (the source recomputes the
    canonical name in every script, twice in some).
    """
    c = contracts.select(
        blank_to_null("b2gnow_id").alias("b2g_id"),
        "prime_vendor", "contract_holder", "business_name",
        norm_label("vendor_type").alias("vendor_type"),
        norm_label("payment_type").alias("payment_type"),
        "amount_paid", "audit_period",
        blank_to_null("taxidnumber").alias("taxidnumber"))
    return c.withColumn("canon_name", canon_name_a("business_name", strip_suffix))


# the four-column natural key as two hashes (128 bits); the second is NULL, and so joins nothing, where a column is
ROW_KEY = ["_ka", "_kb"]
MATCH = ["certification_type", "matched_tax_id", "matched_b2g_id", "match_method_cert"]


def _with_row_key(cn: DataFrame) -> DataFrame:
    """``ROW_KEY``, by which M1 joins instead of four wide columns; cheaper made in each scan than stored."""
    whole = reduce(and_, [F.col(k).isNotNull() for k in CONTRACT_KEY4])
    return cn.withColumns({ROW_KEY[0]: F.xxhash64(*CONTRACT_KEY4), ROW_KEY[1]: F.when(whole, F.xxhash64(F.lit(1), *CONTRACT_KEY4))})


def contract_cert(vendors: DataFrame, contracts: DataFrame, mode: str = "literal",
                  strip_suffix: bool = True, keep=None, normalized: DataFrame | None = None) -> DataFrame:
    """M1: every contract row with the certification of its best vendor match.

    Priority tax id -> vendor-system id -> canonical name.

    ``mode="literal"`` reproduces the source exactly: "already matched" is
    decided on the natural key (vendor id, agency, business, amount, period,
    SQL ``=`` so NULLs never match) and matches are attached back on the
    4-column natural key, so n identical contract rows yield n^2 rows (T7):
    :func:`contract_cert_weighted`, expanded.  ``mode="row_id"`` is the fixed
    form: a per-row cascade, one output row per (row, match).

    ``keep`` (e.g. a written table) is applied to the vendor dimension, which
    the literal plan reads several times; ``normalized`` passes an already stored :func:`contracts_norm`.
    """
    if mode == "literal":
        return expand_copies(contract_cert_weighted(vendors, contracts, strip_suffix, keep, normalized))
    if mode != "row_id":
        raise ValueError(f"unknown mode {mode!r}")
    vd = (keep or (lambda df: df))(best_vendor(vendors, keys=("tax", "b2g", "name"), strip_suffix=strip_suffix))
    cn = normalized if normalized is not None else contracts_norm(contracts, strip_suffix)
    vr = vd.withColumnRenamed("tax_id", "matched_tax_id").withColumnRenamed("b2g_id", "matched_b2g_id")
    steps = [Step("tax_id", F.col("taxidnumber"), vr, "matched_tax_id"),
             Step("b2g_id", F.col("b2g_id"), vr, "matched_b2g_id"),
             Step("name", F.col("canon_name"), vr, "canon_name")]
    return _contract_cert_out(cascade(cn, steps, MATCH[:3], method_col=MATCH[3]))


def contract_cert_weighted(vendors: DataFrame, contracts: DataFrame, strip_suffix: bool = True, keep=None,
                           normalized: DataFrame | None = None) -> DataFrame:
    """M1 (literal) without its copies: every contract row with its distinct matches, each with a count.

    ``_m`` is how often the match is attached to the row (NULL: unmatched,
    once), which is how many rows of M1 it stands for.

    Which key a row is matched by depends on the rows that share its natural
    key.  A row that shares it with none is matched by its own ids and name,
    in the scan where the directory can be broadcast; with ``keep``, these are
    told apart by :func:`spendmatch.operators.groups.split_shared`.  The others
    are decided on a narrow table: the distinct (natural key, ids, name) with
    their counts, one window over each natural key, one join with the vendors;
    of them the wide rows are shuffled once, to take up what their natural key
    has found.  No join meets the copies of a key with each other.
    """
    if keep is not None:
        return contract_matches(vendors, contracts, keep, strip_suffix, normalized).weighted()
    vd = best_vendor(vendors, keys=("tax", "b2g", "name"), strip_suffix=strip_suffix)
    cn = _with_row_key(normalized if normalized is not None else contracts_norm(contracts, strip_suffix))
    return _contract_cert_out(_attached(cn, _cascaded(cn, *_directory(vd))), "_m")


def _directory(vd: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What M1 looks up: the known tax ids and vendor-system ids, and what each step's key offers."""
    def known(key: str, name: str) -> DataFrame:
        return vd.filter(F.col(key).isNotNull()).select(F.col(key).alias(name)).distinct()

    offers = vd.select(
        F.explode(F.array(_step("tax_id", "tax_id"), _step("b2g_id", "b2g_id"), _step("name", "canon_name"))).alias("s"),
        "certification_type", F.col("tax_id").alias("matched_tax_id"), F.col("b2g_id").alias("matched_b2g_id"))
    offers = offers.select("s.*", *MATCH[:3]).filter("_key is not null").groupBy(MATCH[3], "_key", *MATCH[:3]).agg(
        F.count(F.lit(1)).alias("_w"))
    return known("tax_id", "_t"), known("b2g_id", "_b"), offers


@dataclass
class ContractMatches:
    """M1 (literal) before its matches meet the rows: n rows that share a natural key have up to n matches each, so
    the rows with their matches can be many more than both; these are put together where they are read, for the rows that are asked for."""
    rows: DataFrame                     # contracts with ROW_KEY, without the canonical name
    keep: Callable[[DataFrame], DataFrame]
    strip_suffix: bool
    tax: DataFrame
    b2g: DataFrame
    offers: DataFrame
    by_key: Callable[[DataFrame], tuple[DataFrame, DataFrame]]   # rows alone in their natural key, and the rest

    def _named(self, rows: DataFrame) -> DataFrame:
        # names are canonicalised behind the split: the pass for the few rows that share a key does not do it for all
        return rows.withColumn("canon_name", canon_name_a("business_name", self.strip_suffix))

    def _found(self) -> DataFrame:
        return _cascaded(self._named(self.by_key(self.rows)[1]), self.tax, self.b2g, self.offers)

    @cached_property
    def found(self) -> DataFrame:
        """What the shared natural keys have found, stored; a key's matches lie together, where its hashes pack well."""
        return self.keep(self._found().sortWithinPartitions(*ROW_KEY))

    @cached_property
    def _groups(self) -> dict:
        return {}

    def by_total(self, rows: DataFrame, name: str, key) -> tuple[DataFrame, DataFrame]:
        """``rows`` alone in their group of the totals, and the rest; the hashes are counted once for each ``name``."""
        if name not in self._groups:
            self._groups[name] = find_shared(rows, key, self.keep)
        return self._groups[name](rows)

    def weighted(self, rows: DataFrame | None = None, without_b2g: bool = False) -> DataFrame:
        """:func:`contract_cert_weighted` of all rows or some; ``without_b2g`` merges matches that differ in the vendor-system id only."""
        found, offers = self._found() if rows is None else self.found, self.offers
        if without_b2g:
            left = [m for m in MATCH if m != "matched_b2g_id"]
            none = F.lit(None).cast("string")
            offers = bounded_broadcast(offers.groupBy("_key", *left).agg(F.sum("_w").alias("_w")).withColumn("matched_b2g_id", none))
            found = found.repartition(*ROW_KEY).groupBy(*ROW_KEY, *left).agg(F.sum("_m").alias("_m")).withColumn("matched_b2g_id", none)
        alone, several = self.by_key(self.rows if rows is None else rows)
        alone = self._named(alone)
        # a row without a whole natural key takes up nothing
        key = [F.when(F.col("_kb").isNotNull(), F.col(k)) for k in ("taxidnumber", "b2g_id", "canon_name")]
        own = alone.join(self.tax, spread(key[0], alone.columns) == F.col("_t"), "left").join(
            self.b2g, spread(key[1], alone.columns) == F.col("_b"), "left")
        method = F.when(F.col("_t").isNotNull(), F.lit("tax_id")).when(F.col("_b").isNotNull(), F.lit("b2g_id")).otherwise(F.lit("name"))
        own = own.withColumns({"_method": method, "_own": F.coalesce("_t", "_b", key[2])})
        own = own.join(offers, (F.col("_method") == F.col(MATCH[3])) & (spread("_own", alone.columns) == F.col("_key")), "left").withColumn(
            MATCH[3], F.coalesce(MATCH[3], F.lit(UNMATCHED))).withColumnRenamed("_w", "_m")
        return _contract_cert_out(own, "_m").unionByName(_contract_cert_out(_attached(several, found), "_m"))


def contract_matches(vendors: DataFrame, contracts: DataFrame, keep, strip_suffix: bool = True,
                     normalized: DataFrame | None = None) -> ContractMatches:
    """The parts of :func:`contract_cert_weighted`, with the directory and the shared natural keys stored."""
    vd = keep(best_vendor(vendors, keys=("tax", "b2g", "name"), strip_suffix=strip_suffix))
    cn = _with_row_key(normalized if normalized is not None else contracts_norm(contracts, strip_suffix)).drop("canon_name")
    tax, b2g, offers = (bounded_broadcast(keep(df)) for df in _directory(vd))
    return ContractMatches(cn, keep, strip_suffix, tax, b2g, offers,
                           find_shared(cn, F.when(F.col("_kb").isNotNull(), F.col("_ka")), keep))


def _cascaded(cn: DataFrame, tax: DataFrame, b2g: DataFrame, offers: DataFrame) -> DataFrame:
    """What each natural key of ``cn`` has found: its distinct matches with their counts."""
    ids = ["taxidnumber", "b2g_id", "canon_name"]
    few = cn.filter(F.col("_kb").isNotNull()).groupBy(*ROW_KEY, *ids).agg(F.count(F.lit(1)).alias("_n"))
    few = few.join(tax, spread("taxidnumber", ROW_KEY) == F.col("_t"), "left").join(
        b2g, spread("b2g_id", ROW_KEY) == F.col("_b"), "left")
    # a row is past the tax step if a row with its vendor-system id and natural key matched by tax, and left for the
    # name step if no row of its natural key matched by tax or, past that, by vendor-system id
    few = few.repartition(*ROW_KEY)
    tax_hit = F.max(F.col("_t").isNotNull())
    few = few.withColumn("_own", F.col("_b").isNotNull() & ~tax_hit.over(Window.partitionBy(*ROW_KEY, "b2g_id")))
    few = few.withColumn("_taken", F.max(F.col("_t").isNotNull() | F.col("_own")).over(Window.partitionBy(*ROW_KEY)))
    step = F.when(F.col("_t").isNotNull(), _step("tax_id", "taxidnumber")).when(F.col("_own"), _step("b2g_id", "b2g_id")).when(
        ~F.col("_taken"), _step("name", "canon_name"))
    asked = few.select(*ROW_KEY, "_n", step.alias("s")).select(*ROW_KEY, "_n", "s.*")
    return asked.filter("_key is not null").join(offers, [MATCH[3], "_key"]).groupBy(*ROW_KEY, *MATCH).agg(
        F.sum(F.col("_n") * F.col("_w")).alias("_m"))


def _attached(cn: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``cn`` with what their natural key has found."""
    found = found.withColumnsRenamed({k: f"_r{k}" for k in ROW_KEY})
    return cn.join(found, reduce(and_, [F.col(k) == F.col(f"_r{k}") for k in ROW_KEY]), "left").withColumn(
        MATCH[3], F.coalesce(MATCH[3], F.lit(UNMATCHED)))


def _step(method: str, key: str):
    """What a cascade step looks up: its name and the key's value."""
    return F.struct(F.lit(method).alias(MATCH[3]), F.col(key).alias("_key"))


def expand_copies(weighted: DataFrame) -> DataFrame:
    """The rows that ``_m`` stands for (a frame without it is returned as it is)."""
    if "_m" not in weighted.columns:
        return weighted
    return weighted.select("*", F.explode(F.sequence(F.lit(1), F.coalesce("_m", F.lit(1)))).alias("_i")).drop("_i", "_m")


def _weight(cert: DataFrame):
    """How many rows of M1 a row stands for."""
    return F.coalesce("_m", F.lit(1)) if "_m" in cert.columns else F.lit(1)


def _contract_cert_out(df: DataFrame, *more: str) -> DataFrame:
    return df.select("b2g_id", "prime_vendor", "contract_holder", "business_name", "vendor_type",
                     money("amount_paid").alias("amount_paid"), "audit_period", "taxidnumber",
                     *MATCH, *more)


# -------------------------------------------------------------------- M2-M5
def contract_totals(cert: DataFrame | ContractMatches, version: int = 2, keep=None, subs_only: bool = False) -> DataFrame:
    """M2 (v1) / M3 (v2): contract totals by the normalised row identity.

    ``cert`` is M1 or :func:`contract_cert_weighted`, whose counts multiply the
    amounts.  With ``keep`` (``cert`` should be stored then), rows that are
    alone in their group become its total in the scan; only the others are shuffled.
    From :class:`ContractMatches` the contract rows are told apart before they
    meet their matches, so these are shuffled only where groups have several rows.
    ``subs_only``: the subcontractors' totals, by the rows of that type alone.
    """
    matches = cert if isinstance(cert, ContractMatches) else None
    c = (matches.rows if matches else cert).filter(F.col("contract_holder").isNotNull() & F.col("business_name").isNotNull())
    if subs_only:
        c = c.filter(is_sub_type(norm_label("vendor_type")))
    by = {"b2g_id": blank_to_null("b2g_id") if version == 1 else F.col("b2g_id"),
          "prime_vendor": F.col("prime_vendor"),
          "agency_name": F.col("contract_holder"),
          "business_name": F.col("business_name"),
          "vendor_type": norm_label("vendor_type"),
          "tax_id": blank_to_null("taxidnumber"),
          "certification_type": F.col("certification_type"),
          "matched_tax_id": F.col("matched_tax_id").cast("string")}
    own = list(by)[:6]   # what a row has by itself
    names = ["agency_name", "vendor_type", "prime_vendor", "business_name", "tax_id", "b2g_id", "certification_type",
             "matched_tax_id", "match_method_cert"]
    if version == 2:
        by["matched_b2g_id"] = F.col("matched_b2g_id").cast("string")
        names = [*by, "match_method_cert"]
    by["match_method_cert"] = F.col("match_method_cert")
    rest = [F.max("audit_period").alias("audit_period")] if version == 2 else []

    def paid(rows: DataFrame) -> DataFrame:
        amount = F.coalesce("amount_paid", F.lit(0)) * _weight(rows)
        return rows.select(*[by[k].alias(k) for k in names], "audit_period", amount.alias("_paid"))

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*names).agg(*rest, money(F.sum("_paid")).alias("total_amount"))

    def hashed(cols: list):
        # NULL and its place count: a hash that skipped NULLs would mix the columns up
        return F.xxhash64(*[x for k in cols for x in (k, k.isNull())])

    if matches:
        alone, several = matches.by_total(c, f"{subs_only} {version}", hashed([by[k] for k in own]))
        alone, several = paid(matches.weighted(alone, without_b2g=version == 1)), paid(matches.weighted(several))
    elif keep is None:
        return summed(paid(c))
    else:
        alone, several = split_shared(paid(c), hashed([F.col(k) for k in names]), keep)
    single = alone.select(*names, *(["audit_period"] if rest else []), money("_paid").alias("total_amount"))
    return single.unionByName(summed(several))


def contract_groups(normalized: DataFrame) -> DataFrame:
    """The contract rows as M3 groups them, before they are matched and summed: every one is in a group, every group has one."""
    return normalized.filter(F.col("contract_holder").isNotNull() & F.col("business_name").isNotNull()).select(
        "prime_vendor", F.col("contract_holder").alias("agency_name"), norm_label("vendor_type").alias("vendor_type"),
        blank_to_null("taxidnumber").alias("tax_id"))


def contract_subs_cert_spend(totals: DataFrame) -> DataFrame:
    """M4: subcontractor totals with the spend that counts as certified."""
    return totals.filter(is_sub_type("vendor_type")).select(
        "b2g_id", "prime_vendor", "agency_name", "business_name", "vendor_type", "tax_id",
        "certification_type", "matched_tax_id", "matched_b2g_id", "match_method_cert", "audit_period",
        "total_amount",
        money(F.when(is_qualifying("certification_type"), F.col("total_amount"))
              .otherwise(F.lit(0))).alias("certified_spend"))


def contract_prime_summary(subs: DataFrame) -> DataFrame:
    """M5 (inferred; no script builds it): subcontracting per (prime, agency)."""
    g = subs.groupBy("prime_vendor", "agency_name").agg(
        F.sum("total_amount").alias("t"), F.sum("certified_spend").alias("c"),
        F.count(F.lit(1)).alias("sub_count"))
    return g.select("prime_vendor", "agency_name", money("t").alias("total_subs_amount"),
                    money("c").alias("certified_subs_spend"),
                    money(F.col("t") - F.col("c")).alias("uncertified_subs_spend"), "sub_count")


# ----------------------------------------------------------------------- M6
def agency_cert(vendors: DataFrame, spend: DataFrame, include_source: bool = True,
                strip_suffix: bool = True, hot_share: float | None = None) -> DataFrame:
    """M6 (M7 without ``source``): agency/college spend rows with certification.

    Tax id first, then canonical name; every input row is kept (unmatched
    rows get ``unmatched``); a tax id or name with several best vendors fans
    out (T15).  ``hot_share``: see :func:`spendmatch.operators.matching.cascade`.
    """
    vd = best_vendor(vendors, keys=("tax", "name"), strip_suffix=strip_suffix)
    h = spend.withColumn("_tax", blank_to_null("tax_id")) \
             .withColumn("_canon", canon_name_a("business_name", strip_suffix))
    vd2 = vd.withColumnRenamed("tax_id", "matched_tax_id")
    steps = [Step("tax_id", F.col("_tax"), vd2, "matched_tax_id"),
             Step("name", F.col("_canon"), vd2, "canon_name")]
    m = cascade(h, steps,
                ["certification_type", "matched_tax_id"], method_col="match_method", hot_share=hot_share)
    cols = (["source"] if include_source else []) + [
        "agency_number", "agency_name", "business_name", "tax_id",
        money("total_amount").alias("total_amount"), "certification_type", "matched_tax_id", "match_method"]
    return m.select(*cols)


# ----------------------------------------------------------------------- M8
def _contract_flag_tables(cn: DataFrame, strip_suffix: bool = True) -> tuple[DataFrame, DataFrame]:
    """A4/A5: prime/sub presence flags per contract tax id and per canonical name.

    ``COUNT(*) FILTER (WHERE p) > 0`` is ``count_if(p) > 0`` (NULL-safe).  Names
    are counted as they stand first, so each is canonicalised once, not once a row.
    """
    c = cn.filter(F.col("business_name").isNotNull()).select(
        "business_name", F.col("taxidnumber").alias("cn_tax"),
        F.col("vendor_type").alias("vt"), F.col("payment_type").alias("pt"))
    is_prime = F.col("vt").isin(*PRIME_TYPES) | (F.col("pt") == "PRIME")
    is_sub = F.col("vt").isin(*SUB_TYPES) | F.col("pt").isin(*SUB_TYPES)
    flags = [(F.count_if(is_prime) > 0).alias("has_vendor_type_prime"), (F.count_if(is_sub) > 0).alias("has_vendor_type_sub")]
    named = c.groupBy("business_name").agg(*flags).groupBy(canon_name_a("business_name", strip_suffix).alias("cn_name"))
    return (c.filter(F.col("cn_tax").isNotNull()).groupBy("cn_tax").agg(*flags),
            named.agg(*[F.bool_or(f).alias(f) for f in ("has_vendor_type_prime", "has_vendor_type_sub")]))


def agency_cert_flags(agency: DataFrame, contracts: DataFrame, strip_suffix: bool = True,
                      normalized: DataFrame | None = None) -> DataFrame:
    """M8: contract presence flags per agency row — tax id first, then name.

    Both flag tables have one row per key, so the cascade is two left joins
    and a priority pick: no fan-out, no row id, no union.
    """
    cn = normalized if normalized is not None else contracts_norm(contracts, strip_suffix)
    tax_flags, name_flags = _contract_flag_tables(cn, strip_suffix)
    by_tax = tax_flags.select(
        F.col("cn_tax").alias("_t_key"), F.col("has_vendor_type_prime").alias("_t_p"),
        F.col("has_vendor_type_sub").alias("_t_s"))
    by_name = name_flags.select(
        F.col("cn_name").alias("_n_key"), F.col("has_vendor_type_prime").alias("_n_p"),
        F.col("has_vendor_type_sub").alias("_n_s"))
    a = agency.withColumn("_tax", blank_to_null("tax_id")) \
              .withColumn("_canon", canon_name_a("business_name", strip_suffix))
    j = (a.join(by_tax, spread("_tax", agency.columns) == F.col("_t_key"), "left")
          .join(by_name, spread("_canon", agency.columns) == F.col("_n_key"), "left"))
    t_hit = F.col("_t_key").isNotNull()
    n_hit = F.col("_n_key").isNotNull()
    return j.select(
        *agency.columns,
        (t_hit | n_hit).alias("in_contracts_business_name"),
        F.when(t_hit, F.col("_t_p")).when(n_hit, F.col("_n_p")).otherwise(F.lit(False)).alias("has_vendor_type_prime"),
        F.when(t_hit, F.col("_t_s")).when(n_hit, F.col("_n_s")).otherwise(F.lit(False)).alias("has_vendor_type_sub"),
        F.when(t_hit, F.col("_t_key")).alias("matched_taxid_to_contracts"),
        F.when(t_hit, F.lit("tax_id")).when(n_hit, F.lit("name")).otherwise(F.lit(UNMATCHED))
         .alias("match_method_contract"))


# ----------------------------------------------------------------------- M9
PRIME_KEY4 = ["source", "agency_number", "agency_name", "prime_vendor"]


def prime_totals(flags: DataFrame) -> DataFrame:
    """M9: one row per (source, agency, prime, tax id); MAX on text is alphabetical."""
    return flags.groupBy("source", "agency_number", "agency_name",
                         F.col("business_name").alias("prime_vendor"), "tax_id").agg(
        F.max("certification_type").alias("prime_certification_type"),
        F.max("matched_tax_id").alias("matched_tax_id"),
        F.max("match_method").alias("match_method"),
        F.bool_or("in_contracts_business_name").alias("in_contracts_business_name"),
        F.bool_or("has_vendor_type_prime").alias("has_vendor_type_prime"),
        F.bool_or("has_vendor_type_sub").alias("has_vendor_type_sub"),
        F.nullif(F.max(F.coalesce("matched_taxid_to_contracts", F.lit(""))), F.lit(""))
         .alias("matched_taxid_to_contracts"),
        F.nullif(F.max(F.coalesce("match_method_contract", F.lit(""))), F.lit("")).alias("match_method_contract"),
        money(F.sum(F.coalesce("total_amount", F.lit(0)))).alias("prime_total_amount"))


# ---------------------------------------------------------------------- M10
def certified_spend(flags: DataFrame, cert: DataFrame, strip_suffix: bool = True) -> DataFrame:
    """Every agency row with its subcontracting totals and certified spend.

    Subcontract sums are aggregated per (agency, prime) before the join, so
    the join never fans out.  ``cert`` is M1 or :func:`contract_cert_weighted`.
    """
    c = cert.filter(F.col("business_name").isNotNull() & F.col("prime_vendor").isNotNull()
                    & F.col("contract_holder").isNotNull())
    is_sub = F.col("vendor_type").isin(*SUB_TYPES)
    paid = F.col("amount_paid") * _weight(cert)
    # summed by the names as they stand, then by canonical name: a name is canonicalised once, not once a row
    subs = c.groupBy("contract_holder", "prime_vendor").agg(
        F.sum(F.when(is_sub & F.col("certification_type").isNotNull(), paid).otherwise(F.lit(0))).alias("_cert"),
        F.sum(F.when(is_sub & F.col("certification_type").isNull(), paid).otherwise(F.lit(0))).alias("_uncert"))
    subs = subs.groupBy(canon_name_a("contract_holder", strip_suffix).alias("_s_agency"),
                        canon_name_a("prime_vendor", strip_suffix).alias("_s_prime")).agg(
        F.sum("_cert").alias("_cert"), F.sum("_uncert").alias("_uncert"))
    a = flags.withColumn("_a_agency", canon_name_a("agency_name", strip_suffix)) \
             .withColumn("_a_prime", canon_name_a("business_name", strip_suffix))
    j = a.join(subs, (F.col("_a_agency") == F.col("_s_agency")) & (F.col("_a_prime") == F.col("_s_prime")), "left")
    return j.select(
        *flags.columns,
        money(F.coalesce("_cert", F.lit(0))).alias("subs_certified_amount"),
        money(F.coalesce("_uncert", F.lit(0))).alias("subs_uncertified_amount"),
        money(certified_spend_floor("certification_type", F.col("total_amount"), F.col("_cert"),
                                    F.col("_uncert"))).alias("certified_spend"))


# ------------------------------------------------------------------ M11-M14
def primes_canon(primes: DataFrame) -> DataFrame:
    """M9 rows with the canonical names that M11-M14 join by."""
    return primes.select(
        "source", "agency_number", "agency_name", "prime_vendor",
        F.col("tax_id").alias("prime_tax_id"), "prime_certification_type",
        F.col("matched_tax_id").alias("prime_matched_tax_id"),
        F.col("match_method").alias("prime_match_method"), "prime_total_amount",
        canon_name_b("prime_vendor").alias("canon_prime_vendor"),
        canon_name_b("agency_name").alias("canon_agency_name"))


def subs_canon(totals: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """Subcontractor rows of M3 with the canonical names that M11-M14 join by; ``named`` has all their names, if not ``totals``."""
    named = totals if named is None else named
    t = totals.filter(is_sub_type("vendor_type"))
    # a name is canonicalised once, not once a row
    for col, canon in (("prime_vendor", "s_canon_prime"), ("agency_name", "s_canon_agency")):
        names = named.select(F.col(col).alias("_name")).distinct().select("_name", canon_name_b("_name").alias(canon))
        t = t.join(bounded_broadcast(names), F.col(col) == F.col("_name"), "left").drop("_name")
    return t.select(
        F.col("tax_id").alias("s_tax_id"), "s_canon_prime", "s_canon_agency",
        F.col("b2g_id").cast("string").alias("sub_b2g_id"),
        F.col("business_name").alias("sub_business_name"),
        F.col("certification_type").alias("sub_certification_type"),
        F.col("matched_tax_id").cast("string").alias("sub_matched_tax_id"),
        F.col("matched_b2g_id").cast("string").alias("sub_matched_b2g_id"),
        F.col("match_method_cert").alias("sub_match_method"),
        F.col("audit_period").alias("sub_audit_period"),
        F.col("total_amount").alias("sub_amount"),
        F.col("tax_id").cast("string").alias("sub_tax_id"))


SUB_COLS = ["sub_b2g_id", "sub_tax_id", "sub_certification_type", "sub_matched_tax_id", "sub_matched_b2g_id",
            "sub_match_method", "sub_audit_period", "sub_amount"]
PRIME_OUT = ["source", "agency_number", "agency_name", "prime_vendor"]
PRIME_INFO = ["prime_tax_id", "prime_certification_type", "prime_matched_tax_id", "prime_match_method"]


def _null_sub_cols(subs: DataFrame):
    return [F.lit(None).cast(subs.schema[c].dataType).alias(c) for c in SUB_COLS]


def _sub_totals_by_canon(p: DataFrame, s: DataFrame, qualifying: bool) -> DataFrame:
    """Per 4-key prime group: certified / uncertified subcontract sums over the
    canonical-name join, counted once per prime row of the group (as the
    source's LEFT JOIN + GROUP BY does, T13).  Subcontracts are summed per
    canonical key first, so the fan-out join is never materialised."""
    if qualifying:
        cert = is_qualifying("sub_certification_type")
        cert_amt = F.when(cert, F.coalesce("sub_amount", F.lit(0))).otherwise(F.lit(0))
        unc_amt = F.when(F.col("sub_certification_type").isNull() | ~cert,
                         F.coalesce("sub_amount", F.lit(0))).otherwise(F.lit(0))
    else:
        cert_amt = F.when(F.col("sub_certification_type").isNotNull(),
                          F.coalesce("sub_amount", F.lit(0))).otherwise(F.lit(0))
        unc_amt = F.when(F.col("sub_certification_type").isNull(),
                         F.coalesce("sub_amount", F.lit(0))).otherwise(F.lit(0))
    s_sum = s.groupBy("s_canon_prime", "s_canon_agency").agg(F.sum(cert_amt).alias("_c"), F.sum(unc_amt).alias("_u"))
    pg = p.groupBy(*PRIME_OUT, "canon_prime_vendor", "canon_agency_name").agg(F.count(F.lit(1)).alias("_np"))
    j = pg.join(s_sum, (F.col("canon_prime_vendor") == F.col("s_canon_prime"))
                & (F.col("canon_agency_name") == F.col("s_canon_agency")), "left")
    return j.select(*PRIME_OUT,
                    (F.coalesce("_c", F.lit(0)) * F.col("_np")).alias("certified_subs_total"),
                    (F.coalesce("_u", F.lit(0)) * F.col("_np")).alias("uncertified_subs_total"))


def _join_key4(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    r = right.select(*[F.col(c).alias(f"_k_{c}") for c in PRIME_OUT],
                     *[c for c in right.columns if c not in PRIME_OUT])
    cond = None
    for c in PRIME_OUT:
        e = F.col(c) == F.col(f"_k_{c}")
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_k_{c}" for c in PRIME_OUT])


def prime_with_subs(p: DataFrame, s: DataFrame, mode: str = "tax_then_name") -> DataFrame:
    """Prime rows and their subcontractor rows in one table.

    ``p`` and ``s`` are :func:`primes_canon` and :func:`subs_canon`; each is
    read several times, so it should be stored.

    modes: ``rows`` (V1: no certified spend), ``any_cert`` (V2: any
    certification counts), ``qualifying`` (V3: only MBE/WBE/MWBE/SEDBE/CBE),
    ``tax_then_name`` (V4: subs matched by prime tax id within the agency,
    else by canonical prime + agency; adds ``match_method``).
    """
    canon_eq = ((F.col("canon_prime_vendor") == F.col("s_canon_prime"))
                & (F.col("canon_agency_name") == F.col("s_canon_agency")))
    sub_select = [*PRIME_OUT, F.col("sub_business_name").alias("business_name"),
                  F.lit(SUB_LABEL).alias("vendor_type"), *PRIME_INFO]
    if mode == "tax_then_name":
        tax_eq = ((F.col("prime_matched_tax_id").cast("string") == F.col("s_tax_id").cast("string"))
                  & (F.col("canon_agency_name") == F.col("s_canon_agency")))
        by_tax = p.join(s, tax_eq).withColumn("match_method", F.lit("tax_id"))
        by_name_keys = ((F.col("canon_prime_vendor") == F.col("s_canon_prime"))
                        & (F.col("canon_agency_name") == F.col("s_canon_agency")))
        # subcontract sums per match key, aggregated before meeting the primes:
        # the per-prime totals never re-run the prime x subcontract fan-out
        cert = is_qualifying("sub_certification_type")
        c_amt = F.sum(F.when(cert, F.coalesce("sub_amount", F.lit(0))).otherwise(F.lit(0))).alias("_c")
        u_amt = F.sum(F.when(F.col("sub_certification_type").isNull() | ~cert, F.coalesce("sub_amount", F.lit(0)))
                      .otherwise(F.lit(0))).alias("_u")
        s_tax = (s.filter(F.col("s_tax_id").isNotNull())
                  .groupBy(F.col("s_tax_id").cast("string").alias("s_tax_id"), "s_canon_agency").agg(c_amt, u_amt))
        s_name = s.groupBy("s_canon_prime", "s_canon_agency").agg(c_amt, u_amt)
        p_tax = p.join(s_tax, tax_eq)                   # primes with at least one tax match
        p_left = _anti_key4(p, p_tax.select(*PRIME_OUT))
        by_name = p_left.join(s, canon_eq).withColumn("match_method", F.lit("name"))
        matched = by_tax.unionByName(by_name)
        per_prime = (p_tax.select(*PRIME_OUT, "_c", "_u")
                     .unionByName(p_left.join(s_name, by_name_keys).select(*PRIME_OUT, "_c", "_u")))
        st = per_prime.groupBy(*PRIME_OUT).agg(F.sum("_c").alias("certified_subs_total"),
                                               F.sum("_u").alias("uncertified_subs_total"))
        sub_rows = matched.select(*sub_select, F.lit(None).cast("decimal(38,2)").alias("prime_total_amount"),
                                  F.lit(None).cast("decimal(38,2)").alias("certified_spend"),
                                  *SUB_COLS[:-1], money("sub_amount").alias("sub_amount"), "match_method")
        spend_fn = certified_spend_qualifying
    else:
        sub_rows = p.join(s, canon_eq).select(
            *sub_select, F.lit(None).cast("decimal(38,2)").alias("prime_total_amount"),
            *([F.lit(None).cast("decimal(38,2)").alias("certified_spend")] if mode != "rows" else []),
            *SUB_COLS[:-1], money("sub_amount").alias("sub_amount"))
        if mode == "rows":
            st = None
        else:
            st = _sub_totals_by_canon(p, s, qualifying=(mode == "qualifying"))
        spend_fn = certified_spend_any if mode == "any_cert" else certified_spend_qualifying
        if mode not in ("rows", "any_cert", "qualifying"):
            raise ValueError(f"unknown mode {mode!r}")
    prime_base = p.select(*PRIME_OUT, F.col("prime_vendor").alias("business_name"),
                          F.lit(PRIME_LABEL).alias("vendor_type"), *PRIME_INFO, "prime_total_amount")
    if st is None:
        prime_rows = prime_base.select("*", *_null_sub_cols_typed())
    else:
        pj = _join_key4(prime_base, st, "left")
        prime_rows = pj.select(
            *PRIME_OUT, "business_name", "vendor_type", *PRIME_INFO, money("prime_total_amount").alias("prime_total_amount"),
            money(spend_fn("prime_certification_type", F.col("prime_total_amount"), F.col("certified_subs_total"),
                           F.col("uncertified_subs_total"))).alias("certified_spend"),
            *_null_sub_cols_typed())
    if mode == "tax_then_name":
        prime_rows = prime_rows.withColumn("match_method", F.lit(None).cast("string"))
    return prime_rows.unionByName(sub_rows)


def _null_sub_cols_typed():
    types = {"sub_audit_period": "timestamp_ntz", "sub_amount": "decimal(38,2)"}
    return [F.lit(None).cast(types.get(c, "string")).alias(c) for c in SUB_COLS]


def _anti_key4(p: DataFrame, keys: DataFrame) -> DataFrame:
    """Primes whose 4-column key has no row in ``keys`` (SQL ``=``: NULL never matches)."""
    k = keys.select(*[F.col(c).alias(f"_k_{c}") for c in PRIME_OUT]).distinct()
    cond = None
    for c in PRIME_OUT:
        e = F.col(c) == F.col(f"_k_{c}")
        cond = e if cond is None else cond & e
    return p.join(k, cond, "left_anti")


# ---------------------------------------------------------------------- M15
def _prime_tax_lookup(totals: DataFrame) -> DataFrame:
    """Q1: the prime's tax id per (prime, agency) from contract totals.

    The source takes an arbitrary DISTINCT value (``LIMIT 1`` without ORDER);
    we take the smallest non-NULL one so every run agrees (T10).  ``totals`` is
    M3, or the rows that it groups (:func:`contract_groups`).
    """
    return (totals.filter(norm_label("vendor_type") == PRIME_LABEL)
                  .groupBy(F.col("prime_vendor").alias("_l_prime"), F.col("agency_name").alias("_l_agency"))
                  .agg(F.min("tax_id").alias("prime_tax_id")))


def _contract_summary_canon(summary: DataFrame, totals: DataFrame) -> DataFrame:
    lk = _prime_tax_lookup(totals)
    j = summary.join(lk, (F.col("prime_vendor") == F.col("_l_prime")) & (F.col("agency_name") == F.col("_l_agency")),
                     "left")
    return j.select("prime_vendor", "agency_name", "total_subs_amount", "certified_subs_spend",
                    "uncertified_subs_spend", "sub_count", "prime_tax_id",
                    canon_name_b("prime_vendor").alias("c_canon_prime"),
                    canon_name_b("agency_name").alias("c_canon_agency"))


def prime_cert_summary(primes: DataFrame, summary: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per prime (fan-out only for T13 twins) with contract sub totals."""
    p = primes_canon(primes)
    c = _contract_summary_canon(summary, totals).select(
        F.col("prime_tax_id").alias("c_prime_tax_id"), "c_canon_prime", "c_canon_agency",
        F.col("total_subs_amount").alias("c_total"), F.col("certified_subs_spend").alias("c_cert"),
        F.col("uncertified_subs_spend").alias("c_uncert"), F.col("sub_count").alias("c_count"))
    group9 = [*PRIME_OUT, "prime_tax_id", "prime_certification_type", "prime_matched_tax_id", "prime_match_method",
              "prime_total_amount"]
    aggs = [F.sum("c_total").alias("total_subs_amount"), F.sum("c_cert").alias("certified_subs_spend"),
            F.sum("c_uncert").alias("uncertified_subs_spend"), F.sum("c_count").alias("sub_count")]
    tax_eq = ((F.col("prime_matched_tax_id").cast("string") == F.col("c_prime_tax_id").cast("string"))
              & (F.col("canon_agency_name") == F.col("c_canon_agency")))
    by_tax = p.join(c, tax_eq).groupBy(*group9).agg(*aggs).withColumn("match_method", F.lit("tax_id"))
    p_left = _anti_key4(p, by_tax)
    canon_eq = ((F.col("canon_prime_vendor") == F.col("c_canon_prime"))
                & (F.col("canon_agency_name") == F.col("c_canon_agency")))
    by_name = p_left.join(c, canon_eq).groupBy(*group9).agg(*aggs).withColumn("match_method", F.lit("name"))
    m = by_tax.unionByName(by_name).select(*PRIME_OUT, "total_subs_amount", "certified_subs_spend",
                                           "uncertified_subs_spend", "sub_count", "match_method")
    j = _join_key4(p, m, "left")
    unc = F.coalesce("uncertified_subs_spend", F.lit(0))
    spend = (F.when(is_qualifying("prime_certification_type"),
                    F.when(unc > 0, F.col("prime_total_amount") - F.col("uncertified_subs_spend"))
                    .otherwise(F.col("prime_total_amount")))
             .otherwise(F.coalesce("certified_subs_spend", F.lit(0))))
    return j.select(
        *PRIME_OUT, *PRIME_INFO, money("prime_total_amount").alias("prime_total_amount"),
        money(F.coalesce("total_subs_amount", F.lit(0))).alias("total_subs_amount"),
        money(F.coalesce("certified_subs_spend", F.lit(0))).alias("certified_subs_spend"),
        money(F.coalesce("uncertified_subs_spend", F.lit(0))).alias("uncertified_subs_spend"),
        F.coalesce("sub_count", F.lit(0)).cast("bigint").alias("sub_count"),
        "match_method", money(spend).alias("total_certified_spend"))


# ---------------------------------------------------------------------- M16
def unmatched_contract_primes(summary: DataFrame, totals: DataFrame, primes: DataFrame) -> DataFrame:
    """Contract primes with no agency prime by (tax id & agency) or (name & agency).

    ``NOT (A OR B)`` is two equi anti-joins, so no theta join is needed and a
    hot agency never turns into a nested-loop comparison.  Ordered by
    certified subcontract spend, descending with NULLs first (PostgreSQL's
    default, O5).
    """
    c = _contract_summary_canon(summary, totals)
    p = primes_canon(primes)
    p_tax = p.filter(F.col("prime_matched_tax_id").isNotNull()).select(
        F.col("prime_matched_tax_id").cast("string").alias("_p_tax"),
        F.col("canon_agency_name").alias("_p_agency1")).distinct()
    p_name = p.select(F.col("canon_prime_vendor").alias("_p_prime"),
                      F.col("canon_agency_name").alias("_p_agency2")).distinct()
    left = c.join(p_tax, (F.col("prime_tax_id").cast("string") == F.col("_p_tax"))
                  & (F.col("c_canon_agency") == F.col("_p_agency1")), "left_anti")
    left = left.join(p_name, (F.col("c_canon_prime") == F.col("_p_prime"))
                     & (F.col("c_canon_agency") == F.col("_p_agency2")), "left_anti")
    return (left.select("prime_vendor", "agency_name", "prime_tax_id", "total_subs_amount", "certified_subs_spend",
                        "uncertified_subs_spend", "sub_count")
                .orderBy(F.col("certified_subs_spend").desc_nulls_first()))


# ---------------------------------------------------------------------- M17
def agency_filter(summary: DataFrame, excluded: list[str] | None = None) -> DataFrame:
    """The summary without the excluded agencies; a NULL agency is dropped too
    (``NOT IN`` is unknown for NULL).  The list is a literal ``In`` set, which
    Catalyst turns into a hash-set lookup (``InSet``)."""
    names = EXCLUDED_AGENCIES if excluded is None else excluded
    return summary.filter(F.col("agency_name").isNotNull() & ~F.col("agency_name").isin(*names))
