"""Column roles, cleaning, projections and filters."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivo.functions import clean_text, correlation, num_of, rint_round, strip_ws, ts_of
from arrivo.operators.calendar import expand_by_frequency
from arrivo.operators.counters import RunCounters

# Column-name keywords that identify each role in a raw file.
DATE_KEYWORDS = ["indice_tiempo", "anio_trimestre", "año_trimestre", "trimestre", "periodo", "fecha"]
VISITOR_EXACT = ["turistas_no_residentes"]
VISITOR_KEYWORDS = ["turistas", "visitantes", "no_residentes"]
COUNTRY_KEYWORDS = ["pais_de_residencia", "residencia", "pais", "country"]
QUOTE_DATE_NAMES = ["fecha", "date", "fecha_cotizacion"]
QUOTE_PRICE_NAMES = ["venta", "valor", "precio", "price", "sell"]
INTEREST_DATE_NAMES = ["fecha", "date", "fecha_std"]
INTEREST_VALUE_NAMES = ["interes_google", "interes", "interest", "value"]


# ---------------------------------------------------------------- C1-C5 roles

@dataclass(frozen=True)
class Role:
    """A column role: exact names first, then keywords contained in the lower-cased name."""

    name: str
    exact: tuple = ()
    keywords: tuple = ()
    policy: str = "first"  # 'first' or 'last' match in table order (C3)


ARRIVAL_ROLES = (
    Role("period", keywords=tuple(DATE_KEYWORDS)),
    Role("visitors", exact=tuple(VISITOR_EXACT), keywords=tuple(VISITOR_KEYWORDS)),
    Role("country", keywords=tuple(COUNTRY_KEYWORDS)),
)


# Feeds whose columns go by listed names only (C4).
QUOTE_ROLES = (Role("fecha", exact=tuple(QUOTE_DATE_NAMES)), Role("venta", exact=tuple(QUOTE_PRICE_NAMES)))
INTEREST_ROLES = (Role("fecha", exact=tuple(INTEREST_DATE_NAMES)), Role("interes_google", exact=tuple(INTEREST_VALUE_NAMES)))


def resolve_role(columns: list[str], role: Role) -> str | None:
    """Pick the column for one role from the names alone (driver metadata, no job)."""
    exact = [c for c in columns if c.lower() in role.exact]
    if exact:
        return exact[-1] if role.policy == "last" else exact[0]
    hits = [c for c in columns if any(k in c.lower() for k in role.keywords)]
    if not hits:
        return None
    return hits[-1] if role.policy == "last" else hits[0]


def resolve_roles(columns: list[str], roles=ARRIVAL_ROLES) -> tuple[dict, list[str]]:
    """Mapping role -> column, and the roles that are missing (a source with any missing is skipped)."""
    found = {r.name: resolve_role(columns, r) for r in roles}
    missing = [k for k, v in found.items() if v is None]
    return found, missing


def to_roles(df: DataFrame, roles=ARRIVAL_ROLES, keep=("src",)) -> DataFrame | None:
    """Project a raw source onto its roles (renamed); ``None`` when a role is missing."""
    found, missing = resolve_roles(df.columns, roles)
    if missing:
        return None
    return df.select(*[c for c in keep if c in df.columns], *[F.col(v).alias(k) for k, v in found.items()])


def union_by_roles(sources: dict[str, DataFrame], roles=ARRIVAL_ROLES, keep=("src",)) -> tuple[DataFrame, dict[str, list[str]]]:
    """U1 + C5: the sources projected onto their roles and concatenated; a source that lacks a role is skipped.

    Also returns the roles that each skipped source lacks.
    """
    found, skipped = [], {}
    for name, df in sources.items():
        if missing := resolve_roles(df.columns, roles)[1]:
            skipped[name] = missing
        else:
            found.append(to_roles(df, roles, keep))
    if not found:
        raise ValueError(f"no source has all roles: {skipped}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found), skipped


# ---------------------------------------------------------------- C6-C13 standardise

def standardise_arrivals(raw: DataFrame, cat: DataFrame, start: str = "2014-01-01",
                         watch: RunCounters | None = None) -> DataFrame:
    """Raw arrival rows ``(src, period, country, visitors)`` to monthly rows.

    Joins the catalogue (C7, inner: unknown sources are skipped), cleans the
    country (C8), coerces visitors (C10), parses and floors the date (C12, C13,
    on the date itself: quirk Q2 fixed), then expands quarterly rows (T1, T2).
    The catalogue has one row per source (configuration), so the join is a
    broadcast by size.  Output: ``src, indice_tiempo, fecha_std, pais_origen,
    punto_entrada, turistas``.  ``watch`` counts rows, losses and totals while the result is written.
    """
    c = cat.select("src", "frequency", "punto_entrada")
    d = ts_of(raw, "period")
    number = num_of(raw, "visitors").try_cast("long")
    floor = F.lit(start).cast("timestamp_ntz")
    joined = (watch.read(raw) if watch else raw).join(c, "src")
    cols = ["src", "frequency", "punto_entrada", clean_text("country").alias("pais_origen"),
            F.coalesce(number, F.lit(0).cast("long")).alias("turistas"), d.alias("fecha")]
    if watch:
        rows = watch.cleaned(joined.select(*cols, number.alias("_number")), F.col("_number"), F.col("fecha"), floor,
                             F.col("turistas")).drop("_number")
    else:
        rows = joined.select(*cols)
    rows = rows.filter(F.col("fecha").isNotNull() & (F.col("fecha") >= floor))
    out = expand_by_frequency(rows, "fecha", "turistas")
    if watch:
        out = watch.expanded(out, "turistas")
    return out.select("src", "indice_tiempo", "fecha_std", "pais_origen", "punto_entrada", "turistas")


# ---------------------------------------------------------------- C14-C16 side feeds

def clean_quotes(q: DataFrame, house_word: str = "oficial", start: str = "2014-01-01",
                 run_ts: str | None = None) -> DataFrame:
    """C14 + C11 + C12: official quotes only, parsed date in ``[start, run_ts]``, numeric price.

    ``run_ts`` stands for "now" and is a parameter so runs are repeatable;
    ``None`` uses the session's current timestamp.
    """
    end = F.lit(run_ts).cast("timestamp_ntz") if run_ts else F.current_timestamp().cast("timestamp_ntz")
    return (
        q.filter(F.lower(F.col("casa")).contains(house_word.lower()))
        .select(F.col("casa"), ts_of(q, "fecha").alias("fecha"), num_of(q, "venta").alias("venta"))
        .filter(F.col("fecha").isNotNull() & (F.col("fecha") >= F.lit(start).cast("timestamp_ntz"))
                & (F.col("fecha") <= end) & F.col("venta").isNotNull())
    )


def quote_feed_status(clean: DataFrame) -> DataFrame:
    """One status row; an empty or fully filtered feed is rejected."""
    return clean.agg(F.count(F.lit(1)).alias("records")).select(
        "records", F.when(F.col("records") > 0, F.lit("processed")).otherwise(F.lit("error")).alias("status"))


def shape_interest(df: DataFrame, term: str | None = None) -> DataFrame:
    """Drop ``isPartial``, rename the search-term column and ``date`` to the engine's names."""
    out = df.drop("isPartial")
    ren = {}
    if term and term in out.columns:
        ren[term] = "interes_google"
    if "date" in out.columns:
        ren["date"] = "fecha"
    return out.withColumnsRenamed(ren) if ren else out


def clean_interest(df: DataFrame, start: str = "2014-01-01") -> DataFrame:
    """C11 + C12 + C13 for the interest series."""
    return (
        df.select(ts_of(df, "fecha").alias("fecha"), num_of(df, "interes_google").alias("interes_google"))
        .filter(F.col("fecha").isNotNull() & (F.col("fecha") >= F.lit(start).cast("timestamp_ntz"))
                & F.col("interes_google").isNotNull())
    )


# ---------------------------------------------------------------- C18-C19 categories

# Origin and entry-point normalisation rules of the reference
# (keys as they appear after title case; strip is applied first, quirk Q10).
ORIGIN_RULES = {
    "Ee.Uu Y Canadá": "EEUU, Canadá y México",
    "Ee.Uu, Canadá": "EEUU, Canadá y México",
    "Ee.Uu Y Canada": "EEUU, Canadá y México",
    "Ee.Uu, Canada": "EEUU, Canadá y México",
    "EEUU Y Canadá": "EEUU, Canadá y México",
    "EEUU, Canadá": "EEUU, Canadá y México",
    "Ee.Uu, Canadá Y México": "EEUU, Canadá y México",
    "Ee.Uu Y Canadá Y México": "EEUU, Canadá y México",
    "EEUU, Canada Y Mexico": "EEUU, Canadá y México",
    "EEUU Y Canada": "EEUU, Canadá y México",
    "EE.UU Y Canadá": "EEUU, Canadá y México",
    "EE.UU, Canadá": "EEUU, Canadá y México",
    "EE.UU, Canadá Y México": "EEUU, Canadá y México",
    "Europa": "Europa y Resto del Mundo",
    "Europa Y Resto Del Mundo": "Europa y Resto del Mundo",
    "Europa y Resto del Mundo": "Europa y Resto del Mundo",
    "Europa Y Resto Mundo": "Europa y Resto del Mundo",
    "EUROPA": "Europa y Resto del Mundo",
    "EUROPA Y RESTO DEL MUNDO": "Europa y Resto del Mundo",
    "Resto Del Mundo": "Europa y Resto del Mundo",
    "Resto América": "Resto de América",
    "Resto America": "Resto de América",
    "Resto De América": "Resto de América",
    "Resto De America": "Resto de América",
    "RESTO AMÉRICA": "Resto de América",
    "RESTO AMERICA": "Resto de América",
    "Resto América ": "Resto de América",
    " Resto América": "Resto de América",
    "Resto  América": "Resto de América",
}
POINT_RULES = {
    "Aeropuerto Bs As": "Aeropuerto Buenos Aires",
    "Aeropuerto BA": "Aeropuerto Buenos Aires",
    "Aerop. Buenos Aires": "Aeropuerto Buenos Aires",
    "Paso Cristo Redentor ": "Paso Cristo Redentor",
    " Paso Cristo Redentor": "Paso Cristo Redentor",
}


def _rule_map(rules: dict) -> Column:
    """Rules as a literal map keyed by the stripped raw value (no join, stays in codegen)."""
    pairs = {}
    for k, v in rules.items():
        pairs.setdefault(k.strip(), v)
    return F.create_map(*[x for k, v in pairs.items() for x in (F.lit(k), F.lit(v))])


def map_category(c, rules: dict) -> Column:
    """Strip, replace by the rule table when a rule exists, strip again."""
    s = strip_ws(c)
    return strip_ws(F.coalesce(F.element_at(_rule_map(rules), s), s))


def category_report(df: DataFrame, col: str, rules: dict) -> DataFrame:
    """Value counts before and after the rules, with the rule hit per raw value.

    One row per (stage, value): stage ``before`` lists raw values with the
    rule target they hit (NULL if none); stage ``after`` lists the merged values.
    Built from one grouped count of the raw column; the mapping is applied to
    the counts, not to the rows again.
    """
    raw = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    mapped = raw.withColumn("mapped", map_category(F.col("value"), rules))
    total = raw.agg(F.sum("n")).scalar()
    hit = F.element_at(_rule_map(rules), strip_ws(F.col("value")))
    before = mapped.select(F.lit("before").alias("stage"), "value", "n", hit.alias("rule_target"))
    after = mapped.groupBy(F.col("mapped").alias("value")).agg(F.sum("n").alias("n")).select(
        F.lit("after").alias("stage"), "value", F.col("n").cast("long").alias("n"),
        F.lit(None).cast("string").alias("rule_target"))
    both = before.unionByName(after)
    return both.select("stage", "value", "n", "rule_target",
                       rint_round(F.col("n") / total * F.lit(100.0), 2).alias("pct"))


def category_summary(df: DataFrame, col: str, rules: dict) -> DataFrame:
    """C19 totals: categories before/after, merged, rules hit, rows affected (one row)."""
    raw = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.element_at(_rule_map(rules), strip_ws(F.col("value"))).isNotNull()
    return raw.withColumn("mapped", map_category(F.col("value"), rules)).agg(
        F.count("value").alias("categories_before"),
        F.count_distinct("mapped").alias("categories_after"),
        F.count_if(hit).alias("rules_hit"),
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).cast("long").alias("rows_affected"),
        F.sum("n").cast("long").alias("rows"),
    ).withColumn("categories_merged", F.col("categories_before") - F.col("categories_after"))


# ---------------------------------------------------------------- C20-C26

def all_null_columns(df: DataFrame) -> list[str]:
    """C20: names of columns with no non-null value (one aggregate row of counts, then metadata)."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] == 0]


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """C20: drop the columns that are null in every row."""
    return df.drop(*all_null_columns(df))


def drop_zero_target(df: DataFrame, target: str = "turistas") -> DataFrame:
    """Keep rows with a positive target."""
    return df.filter(F.col(target) > 0)


def zero_target_report(df: DataFrame, target: str = "turistas") -> DataFrame:
    """C21 report: rows removed and kept, mean and std before and after (one conditional aggregate)."""
    t = F.col(target).cast("double")
    keep = F.col(target) > 0
    agg = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(keep).alias("rows_after"),
        F.avg(t).alias("mean_before"),
        F.avg(F.when(keep, t)).alias("mean_after"),
        F.stddev_samp(t).alias("std_before"),
        F.stddev_samp(F.when(keep, t)).alias("std_after"),
    )
    return agg.select(
        "rows_before", "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        F.try_divide((F.col("rows_before") - F.col("rows_after")).cast("double") * F.lit(100.0),
                     F.col("rows_before").cast("double")).alias("pct_removed"),
        "mean_before", "mean_after", "std_before", "std_after",
        F.try_divide((F.col("mean_after") - F.col("mean_before")) * F.lit(100.0), F.col("mean_before")).alias("mean_change_pct"),
    )


def filter_values(df: DataFrame, col: str, values) -> DataFrame:
    """Keep rows whose value is in the list."""
    return df.filter(F.col(col).isin(*values))


def flag_to_int(c) -> Column:
    """Boolean flag as 0/1."""
    return (F.col(c) if isinstance(c, str) else c).cast("int")


def features_and_target(df: DataFrame, features: list[str], target: str = "turistas") -> DataFrame:
    """The columns a model expects, in order, then the target."""
    return df.select(*[F.col(f"`{c}`") for c in features], F.col(target))


def scatter_pairs(df: DataFrame, x: str, y: str, group: str | None = None, groups=None) -> DataFrame:
    """The pairs behind a scatter plot, with a correlation per group as the summary that scales."""
    d = df if groups is None else df.filter(F.col(group).isin(*groups))
    keys = [group] if group else []
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        correlation(x, y).alias("corr"),
    )


def scatter_rows(df: DataFrame, x: str, y: str, group: str) -> DataFrame:
    """The pairs themselves, with their group."""
    return df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(x, y, group)
