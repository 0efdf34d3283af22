"""Fact jobs on conformed inputs.

Every builder takes frames with the column names its docstring lists (rename with
``lookups.conform``), casts amounts explicitly and returns one row per source row,
ready for ``rollup.period_rollup``. Code lists that belong to a business are
parameters. Dimension lookups never multiply facts by repeated dimension rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.dates import KEY_FORMAT, as_col, parse_date_exact, reformat_date_loose
from martloom.functions.text import (
    ORDER_LINE_WIDTH,
    combination_code,
    customer_key,
    guarded_cast,
    pad_key,
    product_key,
    try_decimal,
)
from martloom.operators.lookups import flag_member, keep_members, lookup, not_in_or_null, union_conformed
from martloom.operators.members import first_member

AMOUNT = "decimal(19,6)"
# Unknown customers, products and days come as NULL keys, many of them in one place.
SALTS = 64
GRAMS_PER_KG = 1000


def amount(column: Column | str) -> Column:
    return as_col(column).try_cast(AMOUNT)


def _time_key(fact: DataFrame, calendar: DataFrame, column: str) -> DataFrame:
    """The calendar key equal to ``column``; NULL for days outside the calendar."""
    return lookup(fact, calendar, {"time_key": column}, {"time_key": "time_key"}, unique=True, salts=SALTS)


def _month_key(fact: DataFrame, calendar: DataFrame, month: Column) -> DataFrame:
    """First day of the calendar month ``yyyyMM``, as ``time_key``."""
    months = calendar.select("calendar_month", F.date_format("first_day_month", KEY_FORMAT).alias("time_key"))
    return lookup(fact, months, {"calendar_month": month}, ["time_key"])


# --- orders, allocations, forecasts -----------------------------------------------


def require_codes(rules: object, *names: str) -> None:
    """Refuse empty lists of admitted codes: they would drop every row."""
    empty = [n for n in names if not getattr(rules, n)]
    if empty:
        raise ValueError(f"{type(rules).__name__} needs codes for {', '.join(empty)}")


@dataclass(frozen=True)
class OrderFilter:
    """Code lists of the order filter; blocked codes let NULL through and may be empty."""

    document_types: tuple[str, ...]
    item_categories: tuple[str, ...]
    companies: tuple[str, ...]
    blocked_deliveries: tuple[str, ...] = ()
    blocked_reasons: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        require_codes(self, "document_types", "item_categories", "companies")

    def condition(self) -> Column:
        return (
            not_in_or_null("delivery_block", self.blocked_deliveries)
            & F.col("document_type").isin(*self.document_types)
            & not_in_or_null("rejection_reason", self.blocked_reasons)
            & F.col("item_category").isin(*self.item_categories)
            & F.col("customer_order_line").isNotNull()
            & F.col("customer_order").isNotNull()
            & F.col("company").isin(*self.companies)
        )


def build_order_fact(
    orders: DataFrame,
    calendar: DataFrame,
    customers: DataFrame,
    currencies: DataFrame,
    customer_countries: DataFrame,
    countries: DataFrame,
    products: DataFrame,
    wanted: OrderFilter,
) -> DataFrame:
    """Order value and volume.

    ``orders``: document, quantity, allocated_quantity, price, weight_grams, weight_kgs,
    request_date (key text), customer, ship_to, material, currency, customer_order,
    customer_order_line and the filter columns. ``customers``: customer_key;
    ``currencies``: currency_name, currency_key; ``customer_countries``: customer,
    country; ``countries``: country_name, country_key; ``products``: product_key.
    """
    quantity = amount("quantity") + amount("allocated_quantity")
    grams = as_col("weight_grams").try_cast("int")
    by_country = customer_countries.join(
        countries.select("country_name", "country_key").distinct(), F.col("country") == F.col("country_name")
    )
    known = products.select(product_key("product_key").alias("product_key"))
    out = orders.where(wanted.condition())
    out = _time_key(out, calendar, "request_date")
    out = lookup(out, customers, {"customer_key": "customer"}, {"customer_key": "_customer"}, salts=SALTS)
    out = lookup(out, currencies, {"currency_name": "currency"}, ["currency_key"])
    out = lookup(out, by_country, ["customer"], ["country_key"], salts=SALTS)
    out = lookup(out, known, {"product_key": product_key("material")}, {"product_key": "product_key"}, salts=SALTS)
    return out.select(
        F.col("document").alias("sales_document"),
        F.col("quantity").alias("order_quantity"),
        F.col("allocated_quantity").alias("allocated_qty_su"),
        customer_key("ship_to").alias("ship_to_party"),
        F.col("customer_order"),
        pad_key("customer_order_line", ORDER_LINE_WIDTH).alias("customer_order_line"),
        (quantity * F.abs(amount("price"))).alias("order_gsv"),
        F.when(grams == 0, quantity * amount("weight_kgs"))
        .otherwise(quantity * amount("weight_grams") / GRAMS_PER_KG)
        .alias("order_vol"),
        "time_key",
        "product_key",
        customer_key("_customer").alias("customer_key"),
        "currency_key",
        "country_key",
        F.lit("").alias("uom_key"),
        combination_code("product_key", customer_key("_customer")).alias("dim_combination"),
    )


def build_allocation_fact(
    allocations: DataFrame,
    calendar: DataFrame,
    currencies: DataFrame,
    customer_countries: DataFrame,
    countries: DataFrame,
) -> DataFrame:
    """Allocation value and volume.

    ``allocations``: delivery, quantity, price, weight_grams, request_date, customer,
    material, currency. A zero weight gives volume 0.
    """
    grams = as_col("weight_grams").try_cast("bigint")
    quantity = amount("quantity")
    out = _time_key(allocations, calendar, "request_date")
    out = lookup(out, currencies, {"currency_name": "currency"}, ["currency_key"])
    out = lookup(out, customer_countries, ["customer"], {"country": "_country"})
    out = lookup(out, countries, {"country_name": "_country"}, ["country_key"])
    product, customer = product_key("material"), customer_key("customer")
    return out.select(
        F.col("delivery").alias("deliv_no"),
        F.col("request_date").alias("delivery_date"),
        F.col("quantity").alias("batch_determine_qty"),
        (grams / GRAMS_PER_KG).alias("net_weight_in_kgs"),
        (quantity * amount("price")).alias("allocation_gsv"),
        F.when(grams == 0, quantity * grams.cast(AMOUNT))
        .otherwise(quantity * amount("weight_grams") / GRAMS_PER_KG)
        .alias("allocation_vol"),
        "time_key",
        product.alias("product_key"),
        customer.alias("customer_key"),
        "country_key",
        "currency_key",
        F.lit("").alias("uom_key"),
        combination_code(product, customer).alias("dim_combination"),
    )


def build_forecast_fact(
    forecasts: DataFrame, products: DataFrame, currencies: DataFrame, countries: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Forecast volume net of captive volume, keyed by trading-period start.

    ``forecasts``: fiscal_year, trading_period, gross_volume, captive_volume, gsv, pack,
    currency, customer, country. ``products`` needs basepack_code, product_key and
    primary_material; ``calendar`` needs tdp, year and tdp_start.
    """
    primary = products.where("primary_material = '1'")
    periods = calendar.select("tdp", "year", F.date_format("tdp_start", KEY_FORMAT).alias("time_key"))
    out = lookup(forecasts, primary, {"basepack_code": "pack"}, ["product_key"])
    out = lookup(out, currencies, {"currency_name": "currency"}, ["currency_key"])
    out = lookup(out, countries, {"country_name": "country"}, ["country_key"])
    out = lookup(out, periods, {"tdp": as_col("trading_period").cast("string"), "year": as_col("fiscal_year").cast("string")}, ["time_key"])
    customer = customer_key("customer")
    return out.select(
        "fiscal_year",
        "trading_period",
        amount("gross_volume").alias("gross_volume"),
        amount("captive_volume").alias("captive_volume"),
        amount("gsv").alias("fc_gsv"),
        (amount("gross_volume") - amount("captive_volume")).alias("fc_vol"),
        "product_key",
        customer.alias("customer_key"),
        "currency_key",
        "country_key",
        "time_key",
        combination_code("product_key", customer).alias("dim_combination"),
        F.lit("").alias("uom_key"),
    )


# --- finance ----------------------------------------------------------------------


@dataclass(frozen=True)
class FinanceRules:
    """Codes behind the conditional finance measures.

    ``pogo_sources`` maps a cost element to the amount column it takes; other
    elements contribute their own numeric code, NULL contributes 0.
    """

    memo_billing_types: tuple[str, ...]
    direct_record_types: tuple[str, ...]
    other_record_type: str
    barred_channel: str
    special_channels: tuple[str, ...]
    pogo_sources: Mapping[str, str] = field(default_factory=dict)
    # The class labels of the product dimension.
    core_class: str = "CD"
    other_class: str = "NONCD"


# Raw amounts of a finance record.
FINANCE_AMOUNTS = (
    "gross", "distribution", "memo_discount", "unit_adjustment", "turnover_adjustment", "net_volume", "sales_quantity",
    "volume_a", "volume_b",
)
FINANCE_MEASURES = (
    "cigs_volume", "gsv_dist", "gsv_3p", "gross_gsv", "vol_w_memo_wo_pogo", "gsv_w_memo_wo_pogo", "vol_wo_memo_wo_pogo",
    "gsv_wo_memo_wo_pogo", "vol_eaches_w_memo_wo_pogo", "vol_eaches_wo_memo_wo_pogo", "pogo", "memo", "cd_total_gsv",
    "memo_cd_gsv", "noncd_total_gsv", "excluded_bp_cd_gsv", "fin_item_gsv", "st_oh", "non_h_comp_code", "inv_bill_type",
    "gsv_wo_memo_w_pogo", "vol_wo_memo_w_pogo", "vol_eaches_wo_memo_w_pogo",
)


# Conditions of a measure, as bits of one number.
ALWAYS, REGULAR, CORE_BILLED, OTHER_COMPANY, PACK, PACK_DIRECT, SPECIAL, PACK_OTHER, OTHER_CLASS = range(9)

# Measure -> (condition, condition of the first term, first term, second term): the sum of the terms where the
# condition holds, else 0; the first term counts where its own condition holds.
FINANCE_SUMS = {
    "cigs_volume": (ALWAYS, ALWAYS, "volume_a", "volume_b"),
    "gsv_dist": (ALWAYS, ALWAYS, "distribution", None),
    "gsv_3p": (ALWAYS, ALWAYS, "third_party", None),
    "gross_gsv": (ALWAYS, ALWAYS, "third_party", "turnover_adjustment"),
    "vol_w_memo_wo_pogo": (ALWAYS, ALWAYS, "net_volume", None),
    "gsv_w_memo_wo_pogo": (ALWAYS, ALWAYS, "with_memo", None),
    "vol_wo_memo_wo_pogo": (REGULAR, ALWAYS, "net_volume", None),
    "gsv_wo_memo_wo_pogo": (REGULAR, ALWAYS, "with_memo", None),
    "vol_eaches_w_memo_wo_pogo": (ALWAYS, ALWAYS, "sales_quantity", None),
    "vol_eaches_wo_memo_wo_pogo": (REGULAR, ALWAYS, "sales_quantity", None),
    "pogo": (ALWAYS, ALWAYS, "pogo", None),
    "cd_total_gsv": (CORE_BILLED, REGULAR, "with_memo", "pogo"),
    "memo_cd_gsv": (CORE_BILLED, ALWAYS, "with_memo", "pogo"),
    "noncd_total_gsv": (OTHER_COMPANY, ALWAYS, "with_memo", "pogo"),
    "excluded_bp_cd_gsv": (PACK, REGULAR, "with_memo", "pogo"),
    "fin_item_gsv": (PACK_DIRECT, REGULAR, "with_memo", "pogo"),
    "st_oh": (SPECIAL, REGULAR, "with_memo", "pogo"),
    "non_h_comp_code": (PACK_OTHER, REGULAR, "with_memo", "pogo"),
    "inv_bill_type": (OTHER_CLASS, ALWAYS, "pogo", None),
    "gsv_wo_memo_w_pogo": (ALWAYS, REGULAR, "with_memo", "pogo"),
    "vol_wo_memo_w_pogo": (ALWAYS, REGULAR, "net_volume", "pogo"),
    "vol_eaches_wo_memo_w_pogo": (ALWAYS, REGULAR, "sales_quantity", "pogo"),
}
AMOUNTS = "_amounts"
TERM = "decimal(24,6)"


def _amount_names(rules: FinanceRules) -> list[str]:
    return list(dict.fromkeys((*FINANCE_AMOUNTS, *rules.pogo_sources.values())))


def pack_amounts(df: DataFrame, rules: FinanceRules) -> DataFrame:
    """The amounts as one array column, each text cast once.

    Wide rows in single columns make one generated method of all later operators that is
    too large to compile; an array passes through them as one value.
    """
    casts = [amount(c) for c in _amount_names(rules)] + [guarded_cast("cost_element", AMOUNT)]
    return df.withColumn(AMOUNTS, F.array(*casts))


def add_finance_measures(df: DataFrame, rules: FinanceRules) -> DataFrame:
    """Append the derived measures.

    Inputs: the finance amounts as text, billing_type, cost_element, record_type,
    channel, basepack_class and the flags billing_included, company_excluded,
    pack_excluded. A billing type outside the memo list counts as regular and is
    labelled ``Y``. The amounts may come packed (:func:`pack_amounts`).
    """
    columns = [c for c in df.columns if c != AMOUNTS]
    out = df if AMOUNTS in df.columns else pack_amounts(df, rules)
    place = {c: i for i, c in enumerate(_amount_names(rules))}
    raw = lambda c: F.col(AMOUNTS)[place[c]]
    zero = F.lit(0).cast(TERM)
    element = F.col("cost_element")
    pogo = F.when(element.isNull(), F.lit(0).cast(AMOUNT))
    for code, source in rules.pogo_sources.items():
        pogo = pogo.when(element == code, raw(source))
    base = raw("gross") - raw("distribution") - raw("memo_discount")
    terms = {
        "none": zero,
        **{c: raw(c) for c in ("volume_a", "volume_b", "distribution", "turnover_adjustment", "net_volume", "sales_quantity")},
        "third_party": base + raw("unit_adjustment"),
        "with_memo": base - raw("unit_adjustment") + raw("turnover_adjustment"),
        "pogo": pogo.otherwise(F.col(AMOUNTS)[len(place)]),
    }
    regular = F.coalesce(~F.col("billing_type").isin(*rules.memo_billing_types), F.lit(False))
    core, other = F.col("basepack_class") == rules.core_class, F.col("basepack_class") == rules.other_class
    billed, pack_out, company_out = F.col("billing_included"), F.col("pack_excluded"), F.col("company_excluded")
    open_pack = pack_out & ~company_out & (F.col("channel") != rules.barred_channel)
    conditions = {
        ALWAYS: F.lit(True), REGULAR: regular, CORE_BILLED: core & billed, OTHER_COMPANY: other & company_out, PACK: pack_out,
        PACK_DIRECT: open_pack & F.col("record_type").isin(*rules.direct_record_types),
        SPECIAL: ~company_out & F.col("channel").isin(*rules.special_channels),
        PACK_OTHER: open_pack & (F.col("record_type") == rules.other_record_type), OTHER_CLASS: other,
    }
    bits = reduce(
        lambda a, b: a.bitwiseOR(b), (F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in conditions.items())
    )
    # one row of numbers per measure, so that the sums below are one small expression
    at = {name: i for i, name in enumerate(terms)}
    plan = F.array(*[
        F.struct(F.lit(1 << c).alias("c"), F.lit(1 << own).alias("own"), F.lit(at[x]).alias("x"), F.lit(at[y or "none"]).alias("y"))
        for c, own, x, y in FINANCE_SUMS.values()
    ])
    out = out.withColumns({"_terms": F.array(*[t.cast(TERM) for t in terms.values()]), "_bits": bits})
    term, held = F.col("_terms"), F.col("_bits")

    def measure(m: Column) -> Column:
        first = F.when(held.bitwiseAND(m["own"]) != 0, term[m["x"]]).otherwise(zero)
        return F.when(held.bitwiseAND(m["c"]) != 0, first + term[m["y"]]).otherwise(zero.cast("decimal(25,6)"))

    out = out.withColumn("_measures", F.transform(plan, measure))
    numbers = {name: F.col("_measures")[i] for i, name in enumerate(FINANCE_SUMS)}
    memo = F.when(held.bitwiseAND(F.lit(1 << REGULAR)) != 0, "Y").otherwise("N")
    return out.select(*[as_col(c) for c in columns], *[numbers.get(m, memo).alias(m) for m in FINANCE_MEASURES])


def build_finance_fact(
    actuals: DataFrame,
    calendar: DataFrame,
    products: DataFrame,
    countries: DataFrame,
    currencies: DataFrame,
    excluded_packs: DataFrame,
    excluded_companies: DataFrame,
    included_billing: DataFrame,
    rules: FinanceRules,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Finance actuals with every derived measure.

    ``actuals``: the inputs of :func:`add_finance_measures` plus material, pack, company,
    customer, country, currency and posting_date (key text). The three lists are
    one-column frames.
    """
    out = pack_amounts(actuals, rules).drop(*[c for c in _amount_names(rules) if c not in keep])
    out = out.withColumns({"product_key": product_key("material"), "customer_key": customer_key("customer")})
    out = out.withColumn("dim_combination", combination_code("product_key", "customer_key")).drop("material", "customer")
    out = _time_key(out, calendar, "posting_date").drop("posting_date")
    out = lookup(out, products, ["product_key"], ["basepack_class"])
    out = lookup(out, countries, {"country_name": "country"}, ["country_key"])
    out = lookup(out, currencies, {"currency_name": "currency"}, ["currency_key"])
    for name, members, column in (
        ("pack_excluded", excluded_packs, "pack"),
        ("company_excluded", excluded_companies, "company"),
        ("billing_included", included_billing, "billing_type"),
    ):
        out = flag_member(out, members, column, members.columns[0], name)
    out = add_finance_measures(out, rules)
    return out.select(
        *[as_col(c) for c in keep],
        "billing_type",
        *FINANCE_MEASURES,
        "time_key",
        "product_key",
        "customer_key",
        "country_key",
        "currency_key",
        F.lit("").alias("uom_key"),
        "dim_combination",
    )


# The amounts of a planning extract.
PLAN_AMOUNTS = (
    "sales_volume", "gsv_local", "tts_local", "turn_over", "gross_profit", "gross_margin", "total_brand",
    "profit_before_over", "gross_gsv", "gross_volume",
)


def union_plan_extracts(extracts: Sequence[DataFrame], coded_by_name: DataFrame, products: DataFrame) -> DataFrame:
    """UNION ALL of planning extracts; one of them names packs by text and is conformed first.

    Extracts share ``fiscal_month`` (``MMM_yy``), branch, cluster, state, basepack and the
    plan amounts. ``products``: basepack (text), basepack_code.
    """
    coded = lookup(coded_by_name, products, {"basepack": "basepack"}, {"basepack_code": "_code"})
    coded = coded.withColumn("basepack", F.col("_code")).drop("_code")
    return union_conformed(*extracts, coded.select(*extracts[0].columns))


def _plan_month() -> Column:
    return F.date_format(parse_date_exact("fiscal_month", "MMM_yy"), "yyyyMM")


def build_plan_fact(
    plan: DataFrame,
    calendar: DataFrame,
    customers: DataFrame,
    branch_countries: DataFrame,
    countries: DataFrame,
    branches: Sequence[str],
) -> DataFrame:
    """Planning amounts by product and the primary customer of the branch.

    ``customers``: branch, customer_key, primary_customer_branch. Only rows of
    ``branches`` with a known country stay.
    """
    by_branch = branch_countries.select("branch", "country").distinct().join(
        countries.select("country_name", "country_key").distinct(), F.col("country") == F.col("country_name")
    )
    primary = customers.where("primary_customer_branch = '1'")
    out = plan.where(F.col("branch").isin(*branches))
    out = lookup(out, by_branch, ["branch"], ["country_key"], how="inner")
    out = lookup(out, primary, ["branch"], {"customer_key": "_customer"})
    out = _month_key(out, calendar, _plan_month())
    product, customer = product_key("basepack"), customer_key("_customer")
    return out.select(
        "time_key",
        *[amount(c).alias(c) for c in PLAN_AMOUNTS if c in plan.columns],
        product.alias("product_key"),
        customer.alias("customer_key"),
        "country_key",
        combination_code(product, customer).alias("dim_combination"),
        F.lit("").alias("uom_key"),
        F.lit("").alias("currency_key"),
        F.col("fiscal_month").alias("month_year"),
    )


def build_media_plan_fact(
    plan: DataFrame, calendar: DataFrame, state_clusters: DataFrame, pack_brands: DataFrame
) -> DataFrame:
    """Planning amounts by media cluster and media brand.

    ``state_clusters``: state, cluster_key; ``pack_brands``: basepack, media_brand.
    """
    out = lookup(plan, state_clusters, ["state"], ["cluster_key"])
    out = lookup(out, pack_brands, ["basepack"], {"media_brand": "media_product_key"})
    out = _month_key(out, calendar, _plan_month())
    return out.select(
        *[amount(c).alias(c) for c in PLAN_AMOUNTS if c in plan.columns],
        "cluster_key",
        "media_product_key",
        combination_code("cluster_key", "media_product_key").alias("dim_combination"),
        "time_key",
        F.col("fiscal_month").alias("month_year"),
    )


# --- primary sales ----------------------------------------------------------------


@dataclass(frozen=True)
class SalesRules:
    """Filters, channel rules and rate constants of primary sales."""

    branches: tuple[str, ...]
    businesses: tuple[str, ...]
    price_groups: tuple[str, ...]
    companies: tuple[str, ...]
    sales_types: tuple[str, ...]
    invoice_types: tuple[str, ...]
    modern_groups: tuple[str, ...]
    classic_groups: tuple[str, ...]
    modern_channels: tuple[str, ...]
    classic_channels: Mapping[str, str]
    cash_label: str
    retail_label: str
    rate_from_month: str
    low_rate: str
    high_rate: str
    low_rate_businesses: tuple[str, ...] = ()
    cash_chains: tuple[str, ...] = ()
    barred_categories: tuple[str, ...] = ()
    barred_brand: str = ""
    barred_materials: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        require_codes(self, "branches", "businesses", "price_groups", "companies", "sales_types", "invoice_types")


def sales_channel(rules: SalesRules) -> Column:
    """Channel from business group, customer channel and customer chain."""
    modern = F.col("business_group").isin(*rules.modern_groups) & F.col("customer_channel").isin(*rules.modern_channels)
    classic = F.col("business_group").isin(*rules.classic_groups)
    cash = F.col("customer_chain").isin(*rules.cash_chains)
    out = F.when(modern & cash, rules.cash_label).when(modern & ~cash, rules.retail_label)
    for code, label in rules.classic_channels.items():
        out = out.when(classic & (F.col("customer_channel") == code), label)
    return out


def disjoint_rates(rates: DataFrame) -> DataFrame:
    """Validity intervals cut so that at most one covers a month; the later start wins.

    ``rates``: category, brand, start_month, end_month (``yyyyMM``), rate. The window runs
    over the few intervals of one category and brand.
    """
    single = first_member(rates, ["category", "brand", "start_month"], [F.col("end_month").desc(), "rate"])
    following = F.lead("start_month").over(Window.partitionBy("category", "brand").orderBy("start_month"))
    return single.withColumn("next_start", following)


def build_primary_sales_fact(
    sources: Sequence[DataFrame],
    customers: DataFrame,
    materials: DataFrame,
    price_lists: DataFrame,
    rates: DataFrame,
    rules: SalesRules,
) -> DataFrame:
    """Primary sales with channel and tax-uplifted value.

    ``sources`` share month (``yyyyMM``), invoice_type, sales_type, company, customer,
    ship_to, material, qty_pieces, qty_kgs, qty_cases, gsv, captive_value, pogo_value.
    ``customers``: customer, branch, customer_channel, customer_chain. ``materials``:
    material, business_group, category, brand, business, price_list, business_unit.
    ``price_lists``: code, price_group. The rate belongs to the fact's own category,
    brand and month, so rows are never multiplied.
    """
    sales = union_conformed(*sources).where(
        F.col("company").isin(*rules.companies)
        & F.col("sales_type").isin(*rules.sales_types)
        & F.col("invoice_type").isin(*rules.invoice_types)
    )
    listed = keep_members(
        materials.where(
            ~F.col("category").isin(*rules.barred_categories)
            & (F.col("brand") != rules.barred_brand)
            & F.col("business").isin(*rules.businesses)
            & ~F.col("material").isin(*rules.barred_materials)
        ),
        price_lists.where(F.col("price_group").isin(*rules.price_groups)), "price_list", "code",
    )
    branch_customers = customers.where(F.col("branch").isin(*rules.branches))
    out = lookup(sales, branch_customers, ["customer"], ["customer_channel", "customer_chain"], how="inner")
    out = lookup(out, listed, ["material"], ["business_group", "category", "brand", "business_unit"], how="inner")
    month = F.col("month")
    valid = month.between(F.col("start_month"), F.col("end_month")) & (
        F.col("next_start").isNull() | (month < F.col("next_start"))
    )
    out = lookup(
        out, disjoint_rates(rates), ["category", "brand"], ["start_month", "end_month", "next_start", "rate"],
        residual=valid, unique=True,
    )
    low = F.col("business_unit").isin(*rules.low_rate_businesses)
    early = month < rules.rate_from_month
    rate_type = "decimal(10,6)"
    rate = (
        F.when(early & low, F.lit(rules.low_rate).cast(rate_type))
        .when(early & ~low, F.lit(rules.high_rate).cast(rate_type))
        .when(~early, F.col("rate").try_cast(rate_type))
    )
    return out.select(
        F.concat("month", F.lit("01")).alias("time_key"),
        F.col("invoice_type").alias("invc_type"),
        F.col("sales_type").alias("sls_type"),
        F.col("company").alias("co_id"),
        customer_key("customer").alias("customer"),
        "ship_to",
        "material",
        amount("qty_pieces").alias("qty_pcs"),
        amount("qty_kgs").alias("qty_kgs"),
        amount("qty_cases").alias("qty_cases"),
        amount("gsv").alias("gsv"),
        sales_channel(rules).alias("distribution_channel"),
        (amount("gsv") + amount("captive_value") + amount("pogo_value")).alias("gsv_without_pogo"),
        (rate * amount("gsv")).alias("gsv_tur"),
    )


def build_achievement_fact(
    achievements: DataFrame,
    price_lists: DataFrame,
    customers: DataFrame,
    price_groups: Sequence[str],
    channels: Sequence[str],
) -> DataFrame:
    """Trade achievement of listed prices and customers (two semi-joins).

    ``achievements``: day, customer, price_list, sku, total. ``price_lists``: code,
    price_group; ``customers``: customer, customer_channel.
    """
    listed = price_lists.where(F.col("price_group").isin(*price_groups))
    served = customers.where(F.col("customer_channel").isin(*channels))
    out = keep_members(achievements, listed, "price_list", F.trim("code"))
    out = keep_members(out, served, "customer", "customer")
    return out.select(
        F.col("day").alias("time_key"),
        customer_key("customer").alias("customer"),
        "price_list",
        F.col("sku").alias("sku7"),
        amount("total").alias("moc_tot"),
    )


# --- market data ------------------------------------------------------------------


def build_volumetric_fact(
    readings: DataFrame,
    clusters: DataFrame,
    variants: DataFrame,
    default_cluster: str,
    default_variant: str,
    period: str = "Month",
    heavy_brands: Sequence[str] = (),
) -> DataFrame:
    """Market readings of one period type with default members where no mapping exists.

    ``readings``: period, month (``MMMyy``), market, brand, category, manufacturer,
    value_offtake, sales_volume, value_growth. ``clusters``: market, cluster;
    ``variants``: brand, category, manufacturer, variant.
    """
    out = readings.where(F.col("period") == period)
    out = lookup(out, clusters, ["market"], {"cluster": "_cluster"})
    out = lookup(out, variants, ["brand", "category", "manufacturer"], {"variant": "_variant"}, salts=SALTS, heavy=heavy_brands)
    cluster = F.coalesce(F.trim("_cluster"), F.lit(default_cluster))
    variant = F.coalesce(F.trim("_variant"), F.lit(default_variant))
    return out.select(
        *[try_decimal(c).alias(c) for c in ("value_offtake", "sales_volume", "value_growth")],
        cluster.alias("cluster_key"),
        reformat_date_loose("month", "MMMyy", KEY_FORMAT).alias("time_key"),
        variant.alias("media_product_key"),
        combination_code(variant, cluster).alias("combination_code"),
    )


def build_voice_target_fact(targets: DataFrame, clusters: DataFrame, calendar: DataFrame) -> DataFrame:
    """Share-of-voice targets by month name and year.

    ``targets``: cluster, month (``Jan``), year, brand_variant, media, norm_group, target,
    week. ``clusters``: market, cluster_key.
    """
    months = calendar.select(
        F.substring("month_name", 1, 3).alias("month"), "year", F.date_format("first_day_month", KEY_FORMAT).alias("time_key")
    )
    out = lookup(targets, clusters, {"market": "cluster"}, ["cluster_key"])
    out = lookup(out, months, {"month": "month", "year": as_col("year").cast("string")}, ["time_key"])
    return out.select(
        "norm_group",
        amount("target").alias("targets"),
        "time_key",
        "cluster_key",
        F.col("brand_variant").alias("media_product_key"),
        F.col("media").alias("media_key"),
        "week",
    )


def build_spend_target_fact(spends: DataFrame, clusters: DataFrame) -> DataFrame:
    """Share-of-spend actuals; dates like ``1/1/2016`` are taken without a length guard.

    ``spends``: cluster, day (``d/M/yyyy``), brand_variant, media, spend. The month
    lookup of the day contributes no column, so it is not joined at all.
    """
    out = lookup(spends, clusters, {"market": "cluster"}, ["cluster_key"])
    return out.select(
        amount("spend").alias("actual_spends"),
        reformat_date_loose("day", "d/M/yyyy", KEY_FORMAT).alias("time_key"),
        "cluster_key",
        F.col("brand_variant").alias("media_product_key"),
        F.col("media").alias("media_key"),
    )


def build_awareness_fact(survey: DataFrame, synonyms: DataFrame, calendar: DataFrame) -> DataFrame:
    """Spontaneous awareness by quarter label and case-insensitive brand synonym.

    ``survey``: quarter (``Q1_2018``), brand (upper case), market, score. ``synonyms``:
    survey_brand, media_brand.
    """
    quarters = calendar.select(
        F.concat_ws("_", "calendar_quarter", "year").alias("quarter"),
        F.date_format("first_day_quarter", KEY_FORMAT).alias("time_key"),
    )
    labels = synonyms.select(F.upper("survey_brand").alias("brand"), "media_brand")
    out = lookup(survey, labels, ["brand"], {"media_brand": "media_product_key"})
    out = lookup(out, quarters, ["quarter"], ["time_key"])
    return out.select(
        amount("score").alias("spont"), "time_key", "media_product_key", F.col("market").alias("market_key")
    )
