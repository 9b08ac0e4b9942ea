"""One registered query per operator, each with its oracle where SQL can say it.

Queries read the driver's tables or the fixture views over them. Doubles are
rounded at the query boundary, since sums depend on their order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import cleaning as cl
from orrery.functions import dims, keys
from orrery.functions import physics as P
from orrery.operators import audit, calibrate, classify, distinct, identity, impute, lookup, merge, minerals, pool, release, resolve, survivor, validate
from orrery.plans import catalog, fixtures
from orrery.plans.oracle import sql, values, whole
from orrery.plans.staging import new_path, once
from orrery.sources import cards, columnar, delimited, readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
DATE = "2026-01-01"


def query(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLE[name] = oracle
        return f

    return add


def r(c: Column | str, n: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, n)


def fx(spark: SparkSession, sf: str, name: str, texts: dict[str, str] = fixtures.VIEWS) -> DataFrame:
    return fixtures.views(spark, sf, texts)[name]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def stage(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A step of the build over the fixture views, written once per input."""
    make = {
        "merged": lambda: catalog.merged(fixtures.views(spark, sf, written=True), spark),
        "resolved": lambda: resolve.resolve(
            stage(spark, sf, "merged"), catalog.ORDER, dims.density_limits(spark)
        ),
        "derived": lambda: catalog.derived(stage(spark, sf, "resolved"), spark),
        "valid": lambda: validate.split(stage(spark, sf, "derived"), validate.row_rules(stage(spark, sf, "derived").columns))[0],
        "enriched": lambda: catalog.enriched(stage(spark, sf, "valid"), spark),
    }
    return once(spark, sf, name, make[name])


def mass(c: str) -> Column:
    return F.round(F.col(c) / 1e15, 3)


# --- sources and sinks ---------------------------------------------------------


@query("a01_columnar_json", """SELECT CAST(o_orderkey AS BIGINT) AS orderkey, CAST(o_totalprice AS DOUBLE) AS price, o_orderstatus AS status,
 CASE WHEN CAST(floor(o_orderkey/500) AS BIGINT) % 2 = 1 THEN o_orderpriority END AS priority FROM orders""")
def _(spark, sf):
    # Payloads as landed, one a file, of 32 blocks of 500 orders; every second one has a
    # field more, and first.
    block = F.floor(F.col("o_orderkey") / 500)
    more = block % 2 == 1
    own = [F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string"), F.col("o_orderstatus")]
    cells = F.when(more, F.array(F.col("o_orderpriority"), *own)).otherwise(F.array(*own))
    rows = table(spark, sf, "orders").select(cells.alias("d"), (F.floor(block / 64) * 2 + block % 2).alias("g"))
    names = [F.lit(n) for n in ("o_orderkey", "o_totalprice", "o_orderstatus")]
    fields = F.when(F.col("g") % 2 == 1, F.array(F.lit("o_orderpriority"), *names)).otherwise(F.array(*names))
    payload = rows.groupBy("g").agg(F.collect_list("d").alias("data")).select(F.to_json(F.struct(fields.alias("fields"), "data")))
    payload.write.option("maxRecordsPerFile", 1).text(path := new_path(spark, "payloads"))
    renames = {"o_orderkey": "orderkey", "o_totalprice": "price", "o_orderstatus": "status", "o_orderpriority": "priority"}
    out = columnar.columnar_json(spark, path, renames, ("price",), range_bytes=256 << 10)
    return out.select(F.col("orderkey").cast("long").alias("orderkey"), "price", "status", "priority")


@query("a02_parquet_projection", "SELECT p_partkey AS id, p_name AS name FROM part")
def _(spark, sf):
    return readers.wanted_columns(table(spark, sf, "part"), {"p_partkey": "id", "p_name": "name", "no.such": "x"}, ("p_partkey",))[0]


@query("a03_filtered_top_n", """SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P' AND o_custkey IS NOT NULL ORDER BY o_orderdate, o_orderkey LIMIT 500""")
def _(spark, sf):
    # Landed as CSV with a header; columns, filter and top-N are pushed into its scan.
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderdate", "o_orderstatus")
    orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string")).write.option("header", True).csv(path := new_path(spark, "orders-csv"))
    schema = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("string"), "o_orderstatus").schema
    order = ("o_orderdate", "o_orderkey")
    landed = delimited.delimited_first(spark, path, schema, "o_orderkey", 500, order, range_bytes=1 << 20)
    rows = landed.where((F.col("o_orderstatus") != "P") & F.col("o_custkey").isNotNull())
    first = delimited.first_rows(rows, 500, order)
    return first.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast(orders.schema["o_orderdate"].dataType).alias("o_orderdate"))


@query("a04_joined_best", "SELECT l_orderkey AS bid, l_linenumber, o_custkey AS body, NULLIF(l_returnflag, '') AS flag FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(spark, sf):
    best = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("bid"), "l_linenumber", F.col("l_returnflag").alias("flag"))
    body = table(spark, sf, "orders").select(F.col("o_orderkey").alias("bid"), F.col("o_custkey").alias("body"))
    return readers.joined_best(best, body, "bid", texts=("flag",))


@query("a05_identity_links", sql("fx", """SELECT alias, to_designation FROM (SELECT designation AS tod, provisional_designation AS p, name AS n FROM fx_orbits) x,
 LATERAL (SELECT p AS alias, tod AS to_designation UNION ALL SELECT n, tod UNION ALL SELECT 'Other ' || tod, tod WHERE CAST(tod AS BIGINT) % 3 = 0
 UNION ALL SELECT 'Second ' || tod, tod WHERE CAST(tod AS BIGINT) % 3 = 0) WHERE alias IS NOT NULL"""))
def _(spark, sf):
    # Objects as landed, a JSON line each.
    others = F.array(F.concat(F.lit("Other "), "designation"), F.concat(F.lit("Second "), "designation"))
    objects = fx(spark, sf, "fx_orbits").select(
        F.concat(F.lit("("), "designation", F.lit(")")).alias("Number"), F.col("name").alias("Name"),
        F.col("provisional_designation").alias("Principal_desig"), F.when(F.col("designation").cast("long") % 3 == 0, others).alias("Other_desigs"),
    )
    objects.write.json(path := new_path(spark, "links"))
    return readers.identity_links(spark, path)


_MASS = {"number": ("$.number", "long"), "mass": ("$.parameters.physical.mass.value", "double")}


def _landed_cards(spark, sf) -> DataFrame:
    """Cards as landed. One in ten has its mass as text, one in fifteen none at all under
    the name that is wanted, one in fifty is cut short."""
    k = F.col("designation").cast("long")
    value = F.when(k % 10 == 0, F.to_json(F.struct(F.lit("heavy").alias("value")))).otherwise(F.to_json(F.struct(F.col("estimated_mass_kg").alias("value"))))
    mass_ = F.concat(F.when(k % 15 == 0, '"masses": ').otherwise('"mass": '), value)
    text = F.concat(F.lit('{"number": '), "designation", F.lit(', "parameters": {"physical": {'), mass_, F.lit("}}}"))
    lines = fx(spark, sf, "fx_orbits").select(F.when(k % 50 == 7, F.substring(text, 1, 30)).otherwise(text))
    lines.write.text(path := new_path(spark, "cards"))
    return cards.cards(spark, path)


_CARDS = "c AS (SELECT *, CAST(designation AS BIGINT) AS k FROM fx_orbits)"


@query("a06_nested_cards", sql("fx", "SELECT CASE WHEN k % 50 <> 7 THEN k END AS number, CASE WHEN k % 50 <> 7 AND k % 10 <> 0 AND k % 15 <> 0 THEN round(estimated_mass_kg/1e15, 3) END AS mass, k % 50 <> 7 AS readable FROM c", _CARDS))
def _(spark, sf):
    got = cards.flat(_landed_cards(spark, sf), _MASS)
    return got.select("number", F.round(F.col("mass") / 1e15, 3).alias("mass"), F.col("raw").isNull().alias("readable"))


@query("a06_card_drift", sql("fx", """SELECT name, outcome, count(*) AS n FROM (SELECT 'number' AS name, CASE WHEN k % 50 = 7 THEN 'no card' ELSE 'found' END AS outcome FROM c
 UNION ALL SELECT 'mass', CASE WHEN k % 50 = 7 THEN 'no card' WHEN k % 15 = 0 THEN 'missing' WHEN k % 10 = 0 THEN 'other type' WHEN estimated_mass_kg IS NULL THEN 'missing' ELSE 'found' END FROM c) GROUP BY ALL""", _CARDS))
def _(spark, sf):
    return cards.drift(_landed_cards(spark, sf), _MASS).drop("path")


@query("a07_pinned_ids", sql("fx", "SELECT packed AS designation, diameter_km FROM fx_compendium"))
def _(spark, sf):
    # Packed numbers look like integers with leading zeros; a CSV keeps them as text.
    rows = fx(spark, sf, "fx_compendium").select(F.col("packed").alias("designation"), "diameter_km")
    readers.write_csv(rows, path := new_path(spark, "csv"))
    return readers.catalog(spark, path, rows.schema)


@query("a10_csv_sink", sql("fx", "SELECT designation, name, '[' || CAST(CAST(designation AS BIGINT) % 3 AS VARCHAR) || ',7]' AS tags FROM fx_orbits"))
def _(spark, sf):
    # Nested values become JSON text in the file.
    tags = F.array(F.col("designation").cast("long") % 3, F.lit(7)).alias("tags")
    readers.write_csv(fx(spark, sf, "fx_orbits").select("designation", "name", tags), path := new_path(spark, "sink"))
    return spark.read.schema("designation string, name string, tags string").options(header=True, lineSep="\r\n").csv(path)


@query("a11_typed_parquet", sql("fx", "SELECT designation, is_neo, semi_major_axis_au, CAST(NULL AS VARCHAR) AS family FROM fx_orbits"))
def _(spark, sf):
    schema = spark.createDataFrame([], "designation string, is_neo boolean, semi_major_axis_au double, family string").schema
    readers.write_typed(fx(spark, sf, "fx_orbits"), schema, path := new_path(spark, "typed"))
    return spark.read.parquet(path)


@query("a08_row_cap", sql("fx", "SELECT designation FROM fx_orbits ORDER BY CAST(designation AS BIGINT), designation LIMIT 100"))
def _(spark, sf):
    rows = fx(spark, sf, "fx_orbits").select("designation", F.col("designation").cast("long").alias("number"))
    return readers.top_n(rows, 100, "number").select("designation")


@query("a09_source_registry", whole("merged", "SELECT 'orbits' AS source, (SELECT count(*) FROM so) AS n_rows UNION ALL SELECT 'fits', (SELECT count(*) FROM pooled)"))
def _(spark, sf):
    on = catalog.active_sources(fixtures.views(spark, sf, fixtures.WHOLE), {"best": -1, "compendium": -1})
    return readers.build_info({s.name: s.df for s in on})


@query("a12_build_info", sql("fx", "SELECT 'fx_best' AS source, (SELECT count(*) FROM fx_best) AS n_rows, '1.0' AS version UNION ALL SELECT 'fx_links', (SELECT count(*) FROM fx_links), '1.0'"))
def _(spark, sf):
    v = fixtures.views(spark, sf)
    return readers.build_info({k: v[k] for k in ("fx_best", "fx_links")}, version=catalog.VERSION)


# --- cleaning -------------------------------------------------------------------


@query("b01_numeric", "SELECT o_orderkey, try_cast(substr(o_orderdate::VARCHAR, 1, 4) AS DOUBLE) AS y, try_cast(o_orderpriority AS DOUBLE) AS p FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", cl.numeric(F.substring(F.col("o_orderdate").cast("string"), 1, 4)).alias("y"), cl.numeric("o_orderpriority").alias("p"))


@query("b02_flag", sql("fx", "SELECT designation, coalesce(is_neo, false) AS neo FROM fx_orbits"))
def _(spark, sf):
    return fx(spark, sf, "fx_orbits").select("designation", cl.flag("is_neo").alias("neo"))


@query("b03_rename", "SELECT p_partkey AS id, p_name AS label, p_size AS size FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name", "p_size").withColumnsRenamed({"p_partkey": "id", "p_name": "label", "p_size": "size"})


@query("b04_flag_decoding", whole("fx", "SELECT stacked AS raw, CASE WHEN stacked IN ('Y','1') THEN true WHEN stacked IN ('N','0','') THEN false END AS s, CASE WHEN stacked IN ('Y','True') THEN true WHEN stacked IN ('N','False') THEN false END AS y, count(*) AS n FROM fx_fits GROUP BY ALL"))
def _(spark, sf):
    raw = F.col("stacked")
    out = fx(spark, sf, "fx_fits", fixtures.WHOLE).select(raw.alias("raw"), cl.stacked_flag(raw).alias("s"), cl.yes_no(raw).alias("y"))
    return out.groupBy("raw", "s", "y").agg(F.count("*").alias("n"))


@query("b05_units", "SELECT p_partkey, round(p_size/365.25e0, 9) AS years, round(CASE WHEN p_size - 25 > 0 THEN (p_size - 25)/6.67430e-20/1e18 END, 3) AS gm_mass, p_retailprice/1e3 AS thousands FROM part")
def _(spark, sf):
    gm = (F.col("p_size") - 25).cast("double")
    return table(spark, sf, "part").select("p_partkey", r(P.days_to_years(F.col("p_size")), 9).alias("years"), r(P.mass_from_gm(gm) / 1e18, 3).alias("gm_mass"), (F.col("p_retailprice") / 1e3).alias("thousands"))


@query("b06_symmetric_sigma", "SELECT l_orderkey, l_linenumber, round((abs(-l_tax) + abs(l_discount))/2, 9) AS sigma FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r(cl.symmetric_sigma(-F.col("l_tax"), F.col("l_discount")), 9).alias("sigma"))


@query("b07_first_positive", "SELECT l_orderkey, l_linenumber, CASE WHEN l_discount - 5e-2 > 0 THEN l_discount - 5e-2 WHEN l_tax > 0 THEN l_tax END AS v FROM lineitem")
def _(spark, sf):
    arr = F.array(F.col("l_discount") - 5e-2, F.col("l_tax"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", cl.first_positive(arr).alias("v"))


@query("b08_column_fallback", sql("fx", "SELECT designation, round(semi_major_axis_au*9e-1, 9) AS perihelion_au FROM fx_orbits"))
def _(spark, sf):
    df = fx(spark, sf, "fx_orbits").select("designation", "semi_major_axis_au", F.lit(None).cast("double").alias("perihelion_au"))
    return cl.fill_if_column_empty(df, "perihelion_au", F.col("semi_major_axis_au") * (1 - F.lit(0.1))).select("designation", r("perihelion_au", 9).alias("perihelion_au"))


@query("b09_sentinels", sql("fx", "SELECT packed, CASE WHEN diameter_km > 0 THEN diameter_km END AS diameter_km, CASE WHEN absolute_magnitude_h <> 0 AND absolute_magnitude_h < 90 THEN absolute_magnitude_h END AS absolute_magnitude_h FROM fx_compendium"))
def _(spark, sf):
    return cl.mask_sentinels(fx(spark, sf, "fx_compendium")).select("packed", "diameter_km", "absolute_magnitude_h")


@query("b10_fit_codes", whole("src", "SELECT designation, fit_code, count(*) AS n, count(diameter_km) AS nd, count(diameter_sigma_km) AS nds, count(albedo) AS np, count(albedo_sigma) AS nps FROM fit GROUP BY ALL"))
def _(spark, sf):
    out = catalog.fits_source(fx(spark, sf, "fx_fits", fixtures.WHOLE))
    return out.groupBy("designation", "fit_code").agg(F.count("*").alias("n"), F.count("diameter_km").alias("nd"), F.count("diameter_sigma_km").alias("nds"), F.count("albedo").alias("np"), F.count("albedo_sigma").alias("nps"))


_SHAPE = r"^(\d{4} [A-Z]{2}\d*|\d{4} (P-L|T-[123]))$"


@query("b11_name_or_key", sql("fx", rf"SELECT packed, CASE WHEN NOT regexp_matches(name, '{_SHAPE}') THEN name END AS name FROM fx_compendium"))
def _(spark, sf):
    return fx(spark, sf, "fx_compendium").select("packed", keys.name_unless_key(F.col("name")).alias("name"))


@query("b12_source_flags", sql("merged", "SELECT designation, is_o AS source_orbits, is_b AS source_best, is_f AS source_fits, is_c AS source_compendium FROM m"))
def _(spark, sf):
    return stage(spark, sf, "merged").select("designation", *[f"source_{s}" for s in catalog.ORDER])


@query("b13_conditional_label", sql("fx", "SELECT designation, CASE WHEN semi_major_axis_au IS NOT NULL THEN 'TDB' END AS scale, true AS source_orbits FROM fx_orbits"))
def _(spark, sf):
    return fx(spark, sf, "fx_orbits").select("designation", F.when(F.col("semi_major_axis_au").isNotNull(), "TDB").alias("scale"), F.lit(True).alias("source_orbits"))


@query("b14_blank_test", sql("fx", "SELECT spectral_type, spectral_type_tholen, coalesce(trim(spectral_type) IN ('', '-', 'nan', 'NaN', 'None', 'none', '<NA>', 'NA'), true) AS b1, coalesce(trim(spectral_type_tholen) = '', true) AS b2, count(*) AS n FROM fx_orbits GROUP BY ALL"))
def _(spark, sf):
    a, b = F.col("spectral_type"), F.col("spectral_type_tholen")
    out = fx(spark, sf, "fx_orbits").select(a, b, cl.is_blank(a, cl.MISSING_CLASSES).alias("b1"), cl.is_blank(b).alias("b2"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query("b16_stamps", sql("fx", f"SELECT designation, '{DATE}' AS catalog_date, '1.0' AS pipeline_version FROM fx_orbits"))
def _(spark, sf):
    return fx(spark, sf, "fx_orbits").select("designation").withColumns({"catalog_date": F.lit(DATE), "pipeline_version": F.lit(catalog.VERSION)})


@query("b17_tidy_text", sql("fx", "SELECT packed, nullif(trim(family), '') AS family FROM fx_compendium"))
def _(spark, sf):
    return fx(spark, sf, "fx_compendium").select("packed", cl.tidy_text(F.concat(F.lit(" "), "family", F.lit("\t"))).alias("family"))


# --- keys -----------------------------------------------------------------------

_ALL_KEYS = "SELECT raw, canon FROM ck"


def _raw_keys(spark, sf):
    v = fixtures.views(spark, sf, fixtures.WHOLE)
    cols = [("fx_orbits", "designation"), ("fx_orbits", "name"), ("fx_orbits", "provisional_designation"), ("fx_best", "designation"), ("fx_fits", "designation"), ("fx_links", "alias"), ("fx_links", "to_designation"), ("fx_compendium", "name")]
    out = None
    for t, c in cols:
        part = v[t].select(F.col(c).alias("raw"))
        out = part if out is None else out.unionByName(part)
    return out.where("raw is not null").distinct()


@query("c01_canonical", whole("keys", _ALL_KEYS))
def _(spark, sf):
    return _raw_keys(spark, sf).withColumn("canon", keys.canonical(F.col("raw")))


@query("c02_comparison_key", whole("keys", "SELECT raw, upper(trim(canon)) AS k FROM ck"))
def _(spark, sf):
    return _raw_keys(spark, sf).withColumn("k", keys.comparison_key(F.col("raw")))


@query("c03_shape", whole("keys", rf"SELECT raw, regexp_matches(trim(raw), '{_SHAPE}') AS shaped FROM ck"))
def _(spark, sf):
    return _raw_keys(spark, sf).withColumn("shaped", keys.looks_like_designation(F.col("raw")))


@query("c04_unpack", "SELECT p_partkey, substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', CAST(p_partkey % 62 + 1 AS INT), 1) || lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') AS packed, CAST((p_partkey % 62)*10000 + p_partkey % 10000 AS VARCHAR) AS number FROM part")
def _(spark, sf):
    k = F.col("p_partkey")
    packed = F.concat(F.substring(F.lit(keys.BASE62), (k % 62 + 1).cast("int"), F.lit(1)), F.lpad((k % 10000).cast("string"), 4, "0"))
    return table(spark, sf, "part").select("p_partkey", packed.alias("packed")).withColumn("number", keys.unpack_number(F.col("packed")))


@query("c05_parentheses", sql("fx", "SELECT designation, provisional_designation AS inside FROM fx_orbits"))
def _(spark, sf):
    full = F.concat_ws(" ", F.coalesce("name", F.lit("Body")), F.concat(F.lit("( "), "provisional_designation", F.lit(" ) ")))
    return fx(spark, sf, "fx_orbits").select("designation", keys.in_parentheses(full).alias("inside"))


@query("c06_number_or_name", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '1999 AB' || CASE WHEN p_partkey > 0 THEN CAST(p_partkey AS VARCHAR) ELSE '' END ELSE CAST(p_partkey + 1 AS VARCHAR) END AS key FROM part")
def _(spark, sf):
    k = F.col("p_partkey")
    number = F.when(k % 3 != 0, (k + 1).cast("double")).cast("string")
    return table(spark, sf, "part").select("p_partkey", keys.number_or_name(number, F.concat(F.lit(" 1999 ab"), k.cast("string"))).alias("key"))


@query("c07_class_case", sql("merged", "SELECT designation, c1, c2 FROM lab"))
def _(spark, sf):
    return stage(spark, sf, "merged").select("designation", cl.class_label(F.col("spectral_type")).alias("c1"), cl.class_label(F.col("spectral_type_tholen")).alias("c2"))


@query("c08_joined_names", sql("fx", "SELECT designation, nullif(concat_ws(';', CASE WHEN diameter_km IS NOT NULL THEN 'd' END, CASE WHEN albedo IS NOT NULL THEN 'p' END, CASE WHEN is_neo THEN 'n' END), '') AS names FROM fx_orbits"))
def _(spark, sf):
    m = {"d": F.col("diameter_km").isNotNull(), "p": F.col("albedo").isNotNull(), "n": F.col("is_neo")}
    return fx(spark, sf, "fx_orbits").select("designation", cl.joined_names(m).alias("names"))


@query("c09_dictionary", sql("merged", "SELECT g.designation, coalesce(e.density, 0e0) AS density FROM grps g LEFT JOIN cls e ON e.class = g.c1"))
def _(spark, sf):
    density = F.create_map(*[F.lit(x) for c in dims.class_rows() if c[2] is not None for x in (c[0], c[2])])
    value = F.coalesce(density[cl.class_label(F.col("spectral_type"))], F.lit(0.0))
    return distinct.per_distinct(stage(spark, sf, "merged").select("designation", "spectral_type"), ["spectral_type"], {"density": value}).select("designation", "density")


# --- joins ----------------------------------------------------------------------


@query("d01_alias_map", sql("keys", "SELECT alias, tod AS to_designation FROM aliases"))
def _(spark, sf):
    return identity.alias_map(fx(spark, sf, "fx_orbits"))


@query("d02_rekey", sql("keys", "SELECT designation AS raw, key FROM fx_best JOIN rk ON raw = designation UNION ALL SELECT alias, key FROM fx_links JOIN rk ON raw = alias"))
def _(spark, sf):
    v = fixtures.views(spark, sf)
    rows = v["fx_best"].select(F.col("designation").alias("raw"), F.col("designation").alias("key"))
    rows = rows.unionByName(v["fx_links"].select(F.col("alias").alias("raw"), F.col("alias").alias("key")))
    return identity.rekey(rows, identity.alias_map(v["fx_orbits"]), v["fx_links"], "key")


@query("d03_merge", sql("merged", "SELECT designation, name, round(semi_major_axis_au, 6) AS a, round(density_gcm3, 6) AS rho, family, CAST(n_fits AS BIGINT) AS n_fits, round(h_b, 6) AS h_best, round(d_f, 6) AS d_fits, orbit_provider, round(eccentricity, 6) AS ecc, round(inclination_deg, 6) AS inc FROM m"))
def _(spark, sf):
    return stage(spark, sf, "merged").select("designation", "name", r("semi_major_axis_au").alias("a"), r("density_gcm3").alias("rho"), "family", "n_fits", r("absolute_magnitude_h__best").alias("h_best"), r(F.when(F.col("diameter_km__fits") > 0, F.col("diameter_km__fits"))).alias("d_fits"), "orbit_provider", r("eccentricity").alias("ecc"), r("inclination_deg").alias("inc"))


@query("d04_decoded_numbers", sql("fx", "SELECT packed, family, ltrim(packed, '0') AS number FROM fx_compendium"))
def _(spark, sf):
    rows = fx(spark, sf, "fx_compendium")
    decoded = rows.select("packed", keys.unpack_number(F.col("packed")).alias("number")).where("number is not null")
    first = decoded.groupBy("packed").agg(F.min("number").alias("number"))
    return rows.select("packed", "family").join(first, "packed", "left")


@query("d05_dimension_lookup", sql("merged", "SELECT designation, grp, hi AS ceiling FROM grps"))
def _(spark, sf):
    lim = dims.density_limits(spark).select("grp", "ceiling")
    return stage(spark, sf, "merged").select("designation", "grp").join(F.broadcast(lim), "grp", "left").withColumn("ceiling", F.coalesce("ceiling", F.lit(8.0)))


@query("d06_band_join", sql("derived", "SELECT designation, p_orb FROM v2"))
def _(spark, sf):
    p = impute.orbit_albedo(F.col("semi_major_axis_au"), F.col("is_neo"), F.col("absolute_magnitude_h"))
    return stage(spark, sf, "resolved").select("designation", p.alias("p_orb"))


@query("d07_overlap", sql("merged", "SELECT 'best' AS source, count(*) FILTER (key IN (SELECT key FROM so)) AS overlap, count(*) FILTER (key NOT IN (SELECT key FROM so)) AS new_rows, overlap = 0 AS alarm FROM (SELECT DISTINCT key FROM sb) UNION ALL SELECT 'links', count(*) FILTER (key IN (SELECT key FROM so) OR key IN (SELECT key FROM sb)), count(*) FILTER (NOT (key IN (SELECT key FROM so) OR key IN (SELECT key FROM sb))), count(*) FILTER (key IN (SELECT key FROM so) OR key IN (SELECT key FROM sb)) = 0 FROM (SELECT DISTINCT upper(alias) AS key FROM fx_links)"))
def _(spark, sf):
    v = fixtures.views(spark, sf)
    aliases = identity.alias_map(v["fx_orbits"])
    spec = [
        merge.SourceSpec("orbits", v["fx_orbits"].select(keys.canonical(F.col("designation")).alias("designation"))),
        merge.SourceSpec("best", identity.rekey(v["fx_best"].select("designation"), aliases, v["fx_links"])),
        merge.SourceSpec("links", v["fx_links"].select(F.upper("alias").alias("designation"))),
    ]
    return merge.overlap_report(spec)


@query("d08_override", sql("derived", "SELECT designation, round(d, 6) AS d, round(ds, 6) AS ds, d_prov FROM v0"))
def _(spark, sf):
    out = merge.override_diameters(stage(spark, sf, "resolved"), dims.shape_volumes(spark))
    return out.select("designation", r("diameter_km").alias("d"), r("diameter_sigma_km").alias("ds"), F.col("diameter_provider").alias("d_prov"))


@query("d09_card_properties", sql("fx", "SELECT designation, property, status, count(*) AS n FROM (SELECT designation, unnest(['mass', 'diameter', 'absolute_magnitude', 'taxonomy']) AS property, k, estimated_mass_kg, diameter_km, absolute_magnitude_h, spectral_type FROM (SELECT *, CAST(designation AS BIGINT) AS k FROM fx_orbits)) x, LATERAL (SELECT CASE property WHEN 'mass' THEN estimated_mass_kg IS NOT NULL WHEN 'diameter' THEN diameter_km IS NOT NULL WHEN 'absolute_magnitude' THEN true ELSE spectral_type IS NOT NULL END AS has, CASE WHEN k % 5 = 0 THEN 'no card' WHEN property = 'taxonomy' THEN CASE WHEN k % 3 = 0 THEN 'no reference' ELSE 'matches' END WHEN property = 'absolute_magnitude' THEN 'no value' WHEN k % 3 = 0 THEN 'no reference' WHEN k % 4 = 0 THEN 'differs' ELSE 'matches' END AS status) WHERE has GROUP BY ALL"))
def _(spark, sf):
    from orrery.operators import refs

    k = F.col("designation").cast("long")
    bodies = fx(spark, sf, "fx_orbits").select("designation", F.when(k % 2 == 0, F.concat(F.lit("id"), "designation")).alias("ssodnet_id"), "estimated_mass_kg", F.lit(None).cast("double").alias("density_gcm3"), "diameter_km", "absolute_magnitude_h", "spectral_type")
    # Cards as JSON text: k % 5 = 0 has none, k % 3 = 0 no reference, k % 4 = 0 other values.
    off = F.when(k % 4 == 0, 1.01).otherwise(1.0)
    bib = F.when(k % 3 != 0, F.array(F.struct(F.lit("A 2020").alias("shortbib"), F.lit("2020A").alias("bibcode"), F.lit("10.1/x").alias("doi"))))
    v = lambda c: F.struct((F.col(c) * off).alias("value"), bib.alias("bibref"))
    physical = F.struct(v("estimated_mass_kg").alias("mass"), v("diameter_km").alias("diameter"), F.struct(F.col("spectral_type").alias("class"), bib.alias("bibref")).alias("taxonomy"))
    text = F.to_json(F.struct(F.when(k % 2 == 0, F.concat(F.lit("id"), "designation")).alias("id"), k.alias("number"), F.struct(physical.alias("physical")).alias("parameters")))
    cards = fx(spark, sf, "fx_orbits").where(k % 5 != 0).select(F.from_json(text, refs.CARD_SCHEMA).alias("c")).select("c.*")
    rows = refs.property_rows(refs.join_cards(bodies, cards))
    return rows.groupBy("designation", "property", "status").agg(F.count("*").alias("n"))


# --- aggregation and survivorship -------------------------------------------------

_DUP = """dup AS (SELECT CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey AS VARCHAR) ELSE CAST(l_partkey AS VARCHAR) || '.0' END AS designation,
 CASE WHEN l_linenumber % 3 <> 0 THEN l_quantity END AS diameter_km, CASE WHEN l_linenumber % 4 = 0 THEN l_tax END AS diameter_sigma_km,
 CASE WHEN l_linenumber % 5 = 1 THEN l_returnflag END AS mode, CAST(l_orderkey AS BIGINT) AS okey, CAST(l_linenumber AS BIGINT) AS line FROM lineitem)"""


def _dup(spark, sf):
    t, n = table(spark, sf, "lineitem"), F.col("l_linenumber")
    key = F.col("l_partkey").cast("string")
    return t.select(
        F.when(n % 2 == 0, key).otherwise(F.concat(key, F.lit(".0"))).alias("designation"),
        F.when(n % 3 != 0, F.col("l_quantity")).alias("diameter_km"), F.when(n % 4 == 0, F.col("l_tax")).alias("diameter_sigma_km"),
        F.when(n % 5 == 1, F.col("l_returnflag")).alias("mode"), F.col("l_orderkey").cast("long").alias("okey"), n.cast("long").alias("line"),
    )


_KEYED = f"""WITH {_DUP}, k AS (SELECT *, replace(designation, '.0', '') AS key,
 CAST(diameter_km IS NOT NULL AS INT) + CAST(diameter_sigma_km IS NOT NULL AS INT) + CAST(mode IS NOT NULL AS INT) AS f FROM dup)"""
_FIRST = "first({c} ORDER BY f DESC, designation, okey, line) FILTER ({lead} IS NOT NULL) AS {c}"


def _combined(spark, sf) -> DataFrame:
    out = survivor.combine_duplicates(_dup(spark, sf), records=[["diameter_km", "diameter_sigma_km"]], ties=("okey", "line"))
    return out.withColumn("key", keys.comparison_key(F.col("designation")))


@query("e01_combine_duplicates", f"{_KEYED} SELECT key, {_FIRST.format(c='designation', lead='designation')}, {_FIRST.format(c='diameter_km', lead='diameter_km')}, {_FIRST.format(c='mode', lead='mode')}, {_FIRST.format(c='okey', lead='okey')}, {_FIRST.format(c='line', lead='line')} FROM k GROUP BY 1")
def _(spark, sf):
    return _combined(spark, sf).select("key", "designation", "diameter_km", "mode", "okey", "line")


@query("e02_records_travel", f"{_KEYED} SELECT key, {_FIRST.format(c='diameter_km', lead='diameter_km')}, {_FIRST.format(c='diameter_sigma_km', lead='diameter_km')} FROM k GROUP BY 1")
def _(spark, sf):
    # The sigma is that of the row that gave the diameter, or none.
    return _combined(spark, sf).select("key", "diameter_km", "diameter_sigma_km")


@query("e03_adopt_whole", sql("fx", "SELECT designation, CASE WHEN k % 3 = 0 THEN 'a' WHEN k % 5 = 0 THEN 'b' WHEN k % 2 = 0 THEN 'a' WHEN k % 7 = 0 THEN 'b' END AS provider, CASE WHEN k % 3 = 0 THEN k*1e0 WHEN k % 5 = 0 THEN k*2e0 WHEN k % 2 = 0 THEN k*1e0 WHEN k % 7 = 0 THEN k*2e0 END AS x, CASE WHEN k % 3 = 0 THEN 1e0 WHEN k % 5 = 0 THEN 2e0 END AS y FROM (SELECT designation, CAST(designation AS BIGINT) AS k FROM fx_orbits)"))
def _(spark, sf):
    k = F.col("designation").cast("long")
    a = F.struct(F.when((k % 3 == 0) | (k % 2 == 0), k.cast("double")).alias("x"), F.when(k % 3 == 0, 1.0).alias("y"))
    b = F.struct(F.when((k % 5 == 0) | (k % 7 == 0), k * 2.0).alias("x"), F.when(k % 5 == 0, 2.0).alias("y"))
    df = fx(spark, sf, "fx_orbits").select("designation", a.alias("a"), b.alias("b"))
    rec = survivor.adopt_whole([("a", F.col("a"), ["x", "y"]), ("b", F.col("b"), ["x", "y"])], ["x", "y"])
    return df.select("designation", rec.alias("o")).select("designation", "o.provider", "o.x", "o.y")


@query("e04_pool_fits", whole("src", "SELECT key AS designation, round(diameter_km, 6) AS d, round(diameter_sigma_km, 6) AS ds, round(albedo, 6) AS p, round(albedo_sigma, 6) AS ps FROM pooled"))
def _(spark, sf):
    out = catalog.pooled_fits(fx(spark, sf, "fx_fits", fixtures.WHOLE))
    return out.select("designation", r("diameter_km").alias("d"), r("diameter_sigma_km").alias("ds"), r("albedo").alias("p"), r("albedo_sigma").alias("ps"))


_FITS = """f AS (SELECT CAST(l_partkey AS VARCHAR) AS designation, l_tax AS s, l_returnflag AS mode, l_returnflag || '|' || l_linestatus AS refs, CAST(l_orderkey AS BIGINT) AS okey, CAST(l_linenumber AS BIGINT) AS line FROM lineitem)"""


def _ranked_fits(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("designation"), F.col("l_quantity").cast("double").alias("diameter_km"), F.col("l_tax").cast("double").alias("diameter_sigma_km"),
        F.col("l_returnflag").alias("mode"), F.concat_ws("|", "l_returnflag", "l_linestatus").alias("refs"),
        F.col("l_orderkey").cast("long").alias("okey"), F.col("l_linenumber").cast("long").alias("line"),
    )
    return pool.pool(rows, [("diameter_km", "diameter_sigma_km")], texts=("refs",), ties=("okey", "line"))


@query("e05_representative", f"WITH {_FITS} SELECT designation, first(mode ORDER BY s, okey, line) AS mode, first(okey ORDER BY s, okey, line) AS okey, first(line ORDER BY s, okey, line) AS line, count(*) AS n_fits FROM f GROUP BY 1")
def _(spark, sf):
    return _ranked_fits(spark, sf).select("designation", "mode", "okey", "line", "n_fits")


@query("e06_distinct_text", f"WITH {_FITS}, p AS (SELECT designation, s, okey, line, generate_subscripts(x, 1) AS nth, unnest(x) AS piece FROM (SELECT *, string_split(refs, '|') AS x FROM f)), o AS (SELECT designation, piece, min((s, okey, line, nth)) AS o FROM p GROUP BY 1, 2) SELECT designation, string_agg(piece, '|' ORDER BY o) AS refs FROM o GROUP BY 1")
def _(spark, sf):
    return _ranked_fits(spark, sf).select("designation", "refs")


@query("e07_any_and_sum", whole("src", "SELECT key AS designation, stacked, CAST(n_fits AS BIGINT) AS n_fits FROM pooled"))
def _(spark, sf):
    return catalog.pooled_fits(fx(spark, sf, "fx_fits", fixtures.WHOLE)).select("designation", "stacked", "n_fits")


@query("e08_dedup_alarm", f"WITH {_DUP} SELECT 'fits' AS source, count(*) AS rows_in, count(DISTINCT replace(designation, '.0', '')) AS rows_out, false AS alarm FROM dup")
def _(spark, sf):
    return survivor.combine_counted(_dup(spark, sf), "fits")[1]


@query("e09_membership", sql("merged", "SELECT designation, CAST(is_o AS BIGINT) + CAST(is_b AS BIGINT) + CAST(is_f AS BIGINT) + CAST(is_c AS BIGINT) AS n_sources, nullif(concat_ws(';', CASE WHEN is_o THEN 'orbits' END, CASE WHEN is_b THEN 'best' END, CASE WHEN is_f THEN 'fits' END, CASE WHEN is_c THEN 'compendium' END), '') AS sources FROM m"))
def _(spark, sf):
    return stage(spark, sf, "merged").select("designation", "n_sources", "sources")


@query("e10_value_counts", sql("derived", "SELECT d_src AS value, count(*) AS n FROM dv GROUP BY 1"))
def _(spark, sf):
    return lookup.value_counts(stage(spark, sf, "derived"), "diameter_source")


@query("e11_source_counts", sql("merged", "SELECT 'orbits' AS source, count(*) FILTER (is_o) AS n FROM m UNION ALL SELECT 'best', count(*) FILTER (is_b) FROM m UNION ALL SELECT 'fits', count(*) FILTER (is_f) FROM m UNION ALL SELECT 'none', 0"))
def _(spark, sf):
    return audit.source_counts(stage(spark, sf, "merged"), ["orbits", "best", "fits", "none"], spark)


@query("e12_measured_count", sql("derived", "SELECT count(*) FILTER (d_src = 'measured') AS n FROM dv"))
def _(spark, sf):
    return stage(spark, sf, "derived").agg(F.count_if(F.col("diameter_source") == "measured").alias("n"))


# --- resolution -----------------------------------------------------------------


@query("r01_hygiene", sql("merged", "SELECT designation, d_o, d_b, round(d_f, 6) AS d_f, d_c, ds_o FROM m"))
def _(spark, sf):
    out = resolve.hygiene(stage(spark, sf, "merged"), resolve.QUANTITIES["diameter"], catalog.ORDER)
    v = lambda s: F.col(f"_v_diameter__{s}")
    return out.select("designation", v("orbits").alias("d_o"), v("best").alias("d_b"), r(v("fits")).alias("d_f"), v("compendium").alias("d_c"), F.col("_s_diameter__orbits").alias("ds_o"))


@query("r02_precedence", sql("resolved", "SELECT designation, round(h, 6) AS h, h_prov, round(p, 6) AS albedo, p_prov FROM rs"))
def _(spark, sf):
    return stage(spark, sf, "resolved").select("designation", r("absolute_magnitude_h").alias("h"), F.col("h_provider").alias("h_prov"), r("albedo").alias("albedo"), F.col("albedo_provider").alias("p_prov"))


@query("r03_sigma_follows", sql("resolved", "SELECT designation, round(d, 6) AS d, round(ds, 6) AS ds, d_prov, round(ps, 6) AS ps FROM rs"))
def _(spark, sf):
    return stage(spark, sf, "resolved").select("designation", r("diameter_km").alias("d"), r("diameter_sigma_km").alias("ds"), F.col("diameter_provider").alias("d_prov"), r("albedo_sigma").alias("ps"))


def _agree(n: str, spread: str, tol: str) -> str:
    return f"CASE WHEN {n} >= 2 THEN {spread} <= {tol} END"


@query("r04_agreement", sql("resolved", f"SELECT designation, h_n, round(h_spread, 6) AS h_spread, d_n, round(d_spread, 6) AS d_spread, {_agree('d_n', 'd_spread', '1e-1')} AS d_agree, p_n, round(p_spread, 6) AS p_spread, {_agree('p_n', 'p_spread', '25e-2')} AS p_agree, m_n, round(m_spread, 6) AS m_spread, {_agree('m_n', 'm_spread', '25e-2')} AS m_agree FROM rs"))
def _(spark, sf):
    d = stage(spark, sf, "resolved")
    cols = [F.col("designation"), F.col("h_n_sources").alias("h_n"), r("h_spread").alias("h_spread")]
    for short, stem in (("d", "diameter"), ("p", "albedo"), ("m", "mass")):
        cols += [F.col(f"{stem}_n_sources").alias(f"{short}_n"), r(f"{stem}_spread").alias(f"{short}_spread"), F.col(f"{stem}_sources_agree").alias(f"{short}_agree")]
    return d.select(*cols)


@query("r05_refused_names", sql("resolved", "SELECT designation, d_out, p_out, m_out, t_out FROM rs"))
def _(spark, sf):
    return stage(spark, sf, "resolved").select("designation", F.col("diameter_screened_out").alias("d_out"), F.col("albedo_screened_out").alias("p_out"), F.col("mass_screened_out").alias("m_out"), F.col("rotation_period_screened_out").alias("t_out"))


@query("r06_albedo_screen", sql("resolved", "SELECT designation, p_out FROM rs WHERE np_o OR np_b OR np_f"))
def _(spark, sf):
    return stage(spark, sf, "resolved").where("albedo_screened_out is not null").select("designation", F.col("albedo_screened_out").alias("p_out"))


@query("r07_diameter_screen", sql("resolved", "SELECT designation, nd_o, nd_b, nd_f, nd_c FROM r2"))
def _(spark, sf):
    d = stage(spark, sf, "merged")
    for q in ("h", "diameter"):
        d = resolve.hygiene(d, resolve.QUANTITIES[q], catalog.ORDER)
    d = resolve.pick(d, resolve.QUANTITIES["h"], catalog.ORDER, None, False)
    bad = resolve.screen_diameter(d, catalog.ORDER)
    short = {"orbits": "nd_o", "best": "nd_b", "fits": "nd_f", "compendium": "nd_c"}
    return d.select("designation", *[F.coalesce(bad[s], F.lit(False)).alias(n) for s, n in short.items()])


@query("r08_mass_screen", sql("resolved", "SELECT designation, round(mass/1e15, 3) AS mass, m_prov, m_out FROM rs WHERE m_n > 0"))
def _(spark, sf):
    return stage(spark, sf, "resolved").where("mass_n_sources > 0").select("designation", mass("estimated_mass_kg").alias("mass"), F.col("mass_provider").alias("m_prov"), F.col("mass_screened_out").alias("m_out"))


_VOTE = "vote(designation, h, m_o, m_b, d_o) AS (SELECT CAST(p_partkey AS VARCHAR), 1e1, 4e18, 4e18*(1e0 + (p_partkey % 3)/1e1), CASE WHEN p_partkey % 2 = 0 THEN 2e1 ELSE 15e1 END FROM part)"


@query("r09_conflict_vote", f"WITH {_VOTE} SELECT designation, CASE WHEN 4e18/(pi()/6*pow(d_o*1e3, 3))/1e3 > 5 THEN NULL ELSE d_o END AS d, CASE WHEN 4e18/(pi()/6*pow(d_o*1e3, 3))/1e3 > 5 THEN 'orbits' END AS d_out, round(m_b/1e15, 3) AS mass FROM vote")
def _(spark, sf):
    # Two masses against one diameter: the diameter loses the vote.
    k = F.col("p_partkey")
    df = table(spark, sf, "part").select(
        k.cast("string").alias("designation"), F.lit("Unknown").alias("grp"), F.lit(10.0).alias("absolute_magnitude_h__orbits"),
        F.when(k % 2 == 0, 20.0).otherwise(150.0).alias("diameter_km__orbits"),
        F.lit(4e18).alias("estimated_mass_kg__orbits"), (4e18 * (1 + (k % 3) / 10.0)).alias("estimated_mass_kg__best"),
    )
    # H of 10 allows both diameters an albedo, so only the densities speak.
    out = resolve.resolve(df.withColumn("absolute_magnitude_h__orbits", F.lit(None).cast("double")), ["orbits", "best"], dims.density_limits(spark))
    return out.select("designation", F.col("diameter_km").alias("d"), F.col("diameter_screened_out").alias("d_out"), mass("estimated_mass_kg").alias("mass"))


@query("r10_pairing", sql("resolved", "SELECT designation, round(d, 6) AS d, d_prov, m_prov FROM rs WHERE m_prov IS NOT NULL"))
def _(spark, sf):
    return stage(spark, sf, "resolved").where("mass_provider is not null").select("designation", r("diameter_km").alias("d"), F.col("diameter_provider").alias("d_prov"), F.col("mass_provider").alias("m_prov"))


@query("r11_spin_screen", sql("resolved", "SELECT designation, t, t_prov, t_out FROM rs WHERE t_o IS NOT NULL"))
def _(spark, sf):
    return stage(spark, sf, "resolved").where("rotation_period_n_sources > 0").select("designation", F.col("rotation_period_h").alias("t"), F.col("rotation_period_provider").alias("t_prov"), F.col("rotation_period_screened_out").alias("t_out"))


@query("r12_absent_quantities", sql("resolved", "SELECT designation, round(p, 6) AS albedo, p_prov FROM rs"))
def _(spark, sf):
    wide = stage(spark, sf, "merged")
    only = wide.select("designation", "grp", *[c for c in wide.columns if c.startswith(("albedo", "diameter_sigma_km__"))])
    out = resolve.resolve(only, catalog.ORDER, dims.density_limits(spark))
    return out.select("designation", r("albedo").alias("albedo"), F.col("albedo_provider").alias("p_prov"))


# --- physics ----------------------------------------------------------------------

def _physics(name: str, oracle: str, cols: Callable[[Column, Column, Column], dict[str, Column]]) -> None:
    @query(name, f"SELECT l_orderkey, l_linenumber, {oracle} FROM (SELECT *, CAST(l_quantity AS DOUBLE) AS d, CAST(l_quantity % 20 AS DOUBLE) AS h, l_extendedprice*1e12 AS m FROM lineitem)")
    def _(spark, sf):
        d, h = F.col("l_quantity").cast("double"), (F.col("l_quantity") % 20).cast("double")
        made = cols(d, h, F.col("l_extendedprice") * 1e12)
        return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[c.alias(n) for n, c in made.items()])


_physics("m01_sphere_volume", "round(pi()/6*pow(d*1e3, 3)/1e9, 3) AS v", lambda d, h, m: {"v": r(P.sphere_volume_m3(d) / 1e9, 3)})
_physics("m02_bulk_density", "round(m/(pi()/6*pow(d*1e3, 3))/1e3, 6) AS rho", lambda d, h, m: {"rho": r(P.bulk_density(m, d))})
_physics("m03_diameter_from_mass", "round(cbrt(6*m/25e2/pi())/1e3, 6) AS d3", lambda d, h, m: {"d3": r(P.diameter_from_mass(m, F.lit(2.5)))})
_physics("m04_implied_albedo", "round(pow(1329e0/d*pow(1e1, -h/5), 2), 6) AS p", lambda d, h, m: {"p": r(P.implied_albedo(h, d))})
_physics("m05_smallest_diameter", "round(CASE WHEN d > 25 THEN d ELSE 1329e0*pow(1e1, -h/5) END, 6) AS s", lambda d, h, m: {"s": r(P.smallest_diameter(F.when(d > 25, d), h))})
_physics("m06_breakup_period", "round(sqrt(3*pi()/(667430e-16*1e3*(1e0 + l_tax*1e1)))/36e2, 6) AS t", lambda d, h, m: {"t": r(P.min_period_h(1 + F.col("l_tax") * 10))})
_physics("m07_spin", "d >= 1e1 AND l_discount*4e1 < sqrt(3*pi()/(667430e-16*1e3*5e0))/36e2 AS fast", lambda d, h, m: {"fast": P.spins_too_fast(F.col("l_discount") * 40, d, F.lit(5.0))})
_physics("m08_diameter_from_h", "round(1329e0/sqrt(1e-2 + l_discount)*pow(1e1, -h/5), 6) AS d8", lambda d, h, m: {"d8": r(P.diameter_from_h(h, F.col("l_discount") + 0.01))})
_physics("m09_volume_equivalent", "round(cbrt(6*d/pi()), 6) AS v, round(cbrt(6*d/pi())*l_tax/(3*d), 6) AS s", lambda d, h, m: {"v": r(P.volume_equivalent(d)), "s": r(P.volume_equivalent_sigma(d, F.col("l_tax")))})


# --- imputation, validation, gates --------------------------------------------------


@query("v01_albedo_cascade", sql("derived", "SELECT designation, round(p_best, 6) AS p, p_label FROM v3"))
def _(spark, sf):
    return impute.albedo_cascade(stage(spark, sf, "resolved"), spark).select("designation", r("_albedo").alias("p"), F.col("_albedo_label").alias("p_label"))


@query("v02_derive_diameters", sql("derived", "SELECT designation, round(d, 6) AS d, d_src, d_est, round(p_ass, 6) AS p_ass FROM dv"))
def _(spark, sf):
    return stage(spark, sf, "derived").select("designation", r("diameter_km").alias("d"), F.col("diameter_source").alias("d_src"), F.col("derived_diameter_is_estimate").alias("d_est"), r("albedo_assumed_for_diameter").alias("p_ass"))


@query("v03_validation", sql("derived", "SELECT designation FROM vl WHERE reason IS NULL"))
def _(spark, sf):
    d = stage(spark, sf, "derived")
    return validate.split(d, validate.row_rules(d.columns))[0].select("designation")


_BLANKS = "coalesce(trim({c}) IN ('', '-', 'nan', 'NaN', 'None', 'none', '<NA>', 'NA'), true)"


@query("v04_strict_class", sql("derived", f"SELECT coalesce(reason, CASE WHEN {_BLANKS.format(c='spectral_type')} AND {_BLANKS.format(c='spectral_type_tholen')} THEN 'no spectral class' END, 'passed') AS reason, count(*) AS n FROM vl GROUP BY 1"))
def _(spark, sf):
    d = stage(spark, sf, "derived")
    marked = validate.with_reason(d, validate.row_rules(d.columns, strict_class=True))
    return marked.groupBy(F.coalesce("_reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))


@query("v05_rejection_log", sql("derived", "SELECT reason, count(*) AS rejected_count, array_to_string(list_sort(list(designation))[1:5], ',') AS examples FROM vl WHERE reason IS NOT NULL GROUP BY 1"))
def _(spark, sf):
    d = stage(spark, sf, "derived")
    return validate.split(d, validate.row_rules(d.columns))[1].withColumn("examples", F.array_join("examples", ","))


@query("v06_final_gates", sql("enriched", "SELECT coalesce(CASE WHEN isinf(d) OR isinf(mass) OR isinf(rho) THEN 'x' WHEN d < 5 THEN 'diameter below the minimum' END, 'passed') AS reason, count(*) AS n FROM fin GROUP BY 1"))
def _(spark, sf):
    marked = validate.with_reason(stage(spark, sf, "enriched"), validate.gate_rules(5.0))
    return marked.groupBy(F.coalesce("_reason", F.lit("passed")).alias("reason")).agg(F.count("*").alias("n"))


#: The audit's rules over x0 (designation, d, mass, rho, a, mass_s, mass_meas, p, h, d_src, t).
_AUDIT = [
"""x1 AS (SELECT *, mass/(pi()/6*pow(d*1e3, 3e0))/1e3 AS x, pow(1329e0/d*pow(1e1, -h/5e0), 2e0) AS pi_, d_src = 'measured' AS is_m FROM x0)""",
"""x2 AS (SELECT designation, d_src, list_filter([CASE WHEN isinf(d) THEN 'diameter_km is not finite' END, CASE WHEN isinf(mass) THEN 'estimated_mass_kg is not finite' END,
 CASE WHEN isinf(rho) THEN 'density_gcm3 is not finite' END, CASE WHEN isinf(a) THEN 'semi_major_axis_au is not finite' END,
 CASE WHEN mass IS NOT NULL AND d IS NOT NULL AND rho IS NULL THEN 'mass and diameter without density' END,
 CASE WHEN x < 25e-2 OR x > 8 THEN 'implied density impossible' END, CASE WHEN rho < 25e-2 OR rho > 8 THEN 'density impossible' END,
 CASE WHEN abs(x/rho - 1) > 1e-6 THEN 'mass is not density x volume' END, CASE WHEN mass_s IS NOT NULL AND NOT coalesce(mass_meas, false) THEN 'mass sigma without a measured mass' END,
 CASE WHEN p >= 1 THEN 'albedo too high' END, CASE WHEN p < 1e-2 THEN 'albedo too low' END,
 CASE WHEN is_m AND (pi_ < 1e-2*pow(1e1, -3e-1) OR pi_ > pow(1e1, 3e-1)) THEN 'measured diameter contradicts H' END,
 CASE WHEN (CASE WHEN is_m AND d > 0 THEN d ELSE 1329e0*pow(1e1, -h/5e0) END) >= 1e1 AND t < sqrt(3e0*pi()/(667430e-16*1e3*8e0))/36e2 THEN 'spin faster than breakup' END], lambda v: v IS NOT NULL) AS broken FROM x1)""",
]
_PLANTED = """x0 AS (SELECT designation, CASE WHEN k % 41 = 0 THEN 'inf'::DOUBLE ELSE d END AS d, CASE WHEN k % 37 = 0 THEN mass*2 ELSE mass END AS mass,
 CASE WHEN k % 31 = 0 THEN NULL WHEN k % 29 = 0 THEN 9e0 ELSE rho END AS rho, CASE WHEN k % 43 = 0 THEN 'inf'::DOUBLE ELSE a END AS a,
 CASE WHEN k % 47 = 0 THEN 1e0 ELSE mass_s END AS mass_s, mass_meas, CASE WHEN k % 53 = 0 THEN 12e-1 WHEN k % 59 = 0 THEN 1e-3 ELSE p END AS p,
 CASE WHEN k % 23 = 0 THEN 3e0 ELSE h END AS h, d_src, CASE WHEN k % 61 = 0 THEN 5e-1 ELSE t END AS t FROM (SELECT *, try_cast(designation AS BIGINT) AS k FROM fin))"""


@query("v07_physical_audit", sql("enriched", "SELECT rule, count(*) AS n_rows, array_to_string(list_sort(list(designation))[1:5], ',') AS examples FROM (SELECT designation, unnest(broken) AS rule FROM x2) GROUP BY 1", _PLANTED, *_AUDIT))
def _(spark, sf):
    # The finished table with defects of every kind planted.
    k = F.col("designation").try_cast("long")

    def put(name: str, *cases: tuple[int, float | None]) -> Column:
        out = F.col(name)
        for every, value in reversed(cases):
            out = F.when(k % every == 0, F.lit(value).cast("double")).otherwise(out)
        return out

    raw = stage(spark, sf, "enriched").withColumns(
        {
            "diameter_km": put("diameter_km", (41, float("inf"))),
            "estimated_mass_kg": F.when(k % 37 == 0, F.col("estimated_mass_kg") * 2).otherwise(F.col("estimated_mass_kg")),
            "density_gcm3": put("density_gcm3", (31, None), (29, 9.0)),
            "semi_major_axis_au": put("semi_major_axis_au", (43, float("inf"))),
            "estimated_mass_sigma_kg": put("estimated_mass_sigma_kg", (47, 1.0)),
            "albedo": put("albedo", (53, 1.2), (59, 0.001)),
            "absolute_magnitude_h": put("absolute_magnitude_h", (23, 3.0)),
            "rotation_period_h": put("rotation_period_h", (61, 0.5)),
        }
    )
    return audit.violations(raw, audit.physical_rules(raw.columns)).withColumn("examples", F.array_join("examples", ","))


_AS_BUILT = "x0 AS (SELECT designation, d, mass, rho, a, mass_s, mass_meas, p, h, d_src, t FROM fin)"


def _stamped(spark, sf) -> DataFrame:
    return stage(spark, sf, "enriched").withColumns({"catalog_date": F.lit(DATE), "pipeline_version": F.lit(catalog.VERSION)})


@query("v08_release_gate", sql("enriched", """SELECT 'too few rows from none' AS problem UNION ALL SELECT 'too few rows' FROM (SELECT count(*) AS n FROM fin) WHERE n < 100000000
 UNION ALL SELECT DISTINCT unnest(broken) FROM x2""", _AS_BUILT, *_AUDIT))
def _(spark, sf):
    problems, _ = release.gate(_stamped(spark, sf), catalog.VERSION, {"orbits": 1, "none": 1}, row_floor=100_000_000, measured_floor=1)
    return release.problems_table(spark, problems)


_SOUND = """sound AS (SELECT f.*, coalesce(try_cast(f.designation AS BIGINT), 1) % 3 <> 0 AS stays FROM fin f JOIN x2 ON x2.designation = f.designation WHERE len(broken) = 0)"""
_PER_SOURCE = "per_source AS (" + " UNION ALL ".join(f"SELECT '{n}' AS s, count(*) FILTER (is_{n[0]}) AS n, count(*) FILTER (is_{n[0]} AND stays) AS m FROM sound" for n in catalog.ORDER) + ")"


def _published(spark, sf) -> tuple[DataFrame, str]:
    """The rows that the audit lets through, and the folder in which they are released."""
    kept, log = validate.split(_stamped(spark, sf), audit.physical_rules(stage(spark, sf, "enriched").columns))
    problems, found = release.gate(kept, catalog.VERSION, {"orbits": 1}, row_floor=1, measured_floor=1)
    release.publish(kept, log, root := new_path(spark, "releases"), DATE, problems, found)
    return kept, root


@query("v08_shrink_gate", sql("enriched", """SELECT 'fewer rows than before' AS problem FROM sound HAVING count(*) FILTER (stays) < count(*)*995e-3
 UNION ALL SELECT 'fewer rows from ' || s || ' than before' FROM per_source WHERE m < n*98e-2""", _AS_BUILT, *_AUDIT, _SOUND, _PER_SOURCE))
def _(spark, sf):
    # The next release lacks a third of the bodies; it is held against the last manifest.
    kept, root = _published(spark, sf)
    fewer = kept.where(F.coalesce(F.col("designation").try_cast("long"), F.lit(1)) % 3 != 0)
    problems, _ = release.gate(fewer, catalog.VERSION, {"orbits": 1}, 1, 1, previous=release.previous(spark, root))
    return release.problems_table(spark, problems)


@query("v09_gated_publish", sql("enriched", "SELECT count(*) FILTER (len(broken) = 0) AS n_rows, count(*) FILTER (len(broken) = 0 AND d_src = 'measured') AS n_measured, count(*) FILTER (len(broken) > 0) AS n_rejected FROM x2", _AS_BUILT, *_AUDIT))
def _(spark, sf):
    # Rows that the audit refuses go to the log, and every gate must then pass.
    _, root = _published(spark, sf)
    return spark.read.schema(release.MANIFEST).json(f"{root}/{DATE}/manifest").select("n_rows", "n_measured", "n_rejected")


@query("v09_manifest_sources", sql("enriched", "SELECT s AS source, n FROM per_source WHERE n > 0", _AS_BUILT, *_AUDIT, _SOUND, _PER_SOURCE))
def _(spark, sf):
    last = release.previous(spark, _published(spark, sf)[1])
    return spark.createDataFrame(list(last["sources"].items()), "source string, n long")


@query("b15_column_order", sql("resolved", "SELECT designation, round(d, 6) AS diameter_km, d_prov AS diameter_provider, semi_major_axis_au FROM rs"))
def _(spark, sf):
    d = stage(spark, sf, "resolved").select("diameter_provider", "semi_major_axis_au", r("diameter_km").alias("diameter_km"), "designation")
    return merge.column_order(d, ["designation"], {"diameter_km": ["diameter_provider"]})


@query("v10_suspects", sql("enriched", """SELECT rule, count(*) AS n_rows FROM (SELECT unnest(list_filter([
 CASE WHEN mass_meas AND (x < 25e-2 OR x > m_hi) THEN 'measured mass outside its class''s density' END, CASE WHEN mass_meas AND x > 5 THEN 'measured mass above 5 g/cm3' END,
 CASE WHEN d_src = 'measured' AND pi_ > 1 THEN 'implied albedo above 1' END, CASE WHEN d_src = 'measured' AND pi_ < 1e-2 THEN 'implied albedo below 0.01' END,
 CASE WHEN d_spread > 1 THEN 'diameter sources disagree' END, CASE WHEN p_spread > 2 THEN 'albedo sources disagree' END, CASE WHEN m_spread > 1 THEN 'mass sources disagree' END,
 CASE WHEN abs(d_spread - 999) < 5 THEN 'diameter sources differ 1000x' END, CASE WHEN h_spread > 1 THEN 'h sources disagree' END,
 CASE WHEN mass_meas AND mass_s >= 5e-1*mass THEN 'large mass sigma' END, CASE WHEN ps >= p THEN 'large albedo sigma' END, CASE WHEN mass IS NULL THEN 'no mass' END,
 CASE WHEN d_out IS NOT NULL THEN 'diameter value refused' END, CASE WHEN p_out IS NOT NULL THEN 'albedo value refused' END, CASE WHEN m_out IS NOT NULL THEN 'mass value refused' END,
 CASE WHEN t_out IS NOT NULL THEN 'rotation_period value refused' END], lambda v: v IS NOT NULL)) AS rule
 FROM (SELECT *, mass/(pi()/6*pow(d*1e3, 3))/1e3 AS x, pow(1329e0/d*pow(1e1, -h/5e0), 2) AS pi_ FROM fin)) GROUP BY 1"""))
def _(spark, sf):
    d = audit.with_class_limits(stage(spark, sf, "enriched"), spark)
    return audit.violations(d, audit.suspect_rules(d.columns)).select("rule", "n_rows")


@query("v11_reference_keys", sql("derived", "SELECT k.designation, CASE WHEN d.designation IS NULL THEN 'missing' WHEN d_src = 'measured' THEN 'ok' ELSE d_src END AS status FROM k LEFT JOIN dv d USING (designation)", values("k", "designation", [(k,) for k in audit.REFERENCE_KEYS])))
def _(spark, sf):
    return audit.reference_check(stage(spark, sf, "derived"), spark)


# --- classification ------------------------------------------------------------------


@query("n01_class_cascade", sql("enriched", "SELECT designation, cls_ AS class, c_src FROM n1"))
def _(spark, sf):
    return classify.classify(stage(spark, sf, "valid")).select("designation", F.col("spectral_type").alias("class"), F.col("spectral_type_source").alias("c_src"))


@query("n02_composition_row", sql("enriched", "SELECT designation, key_, row_, lgrp FROM n2"))
def _(spark, sf):
    d = classify.composition_key(stage(spark, sf, "enriched").select("designation", "spectral_type", "semi_major_axis_au", "_limits_group"))
    row = classify.icy_row(F.col("_row"), F.col("semi_major_axis_au"))
    return d.select("designation", F.col("_row").alias("key_"), row.alias("row_"), F.col("_limits_group").alias("lgrp"))


@query("n03_albedo_split", sql("enriched", "SELECT designation, comp FROM n2"))
def _(spark, sf):
    return stage(spark, sf, "enriched").select("designation", F.col("comp_class").alias("comp"))


@query("n04_composition", sql("enriched", "SELECT designation, comp_group, rho_est, metal, silicate, carbon, ice FROM n3"))
def _(spark, sf):
    return stage(spark, sf, "enriched").select("designation", "comp_group", F.col("comp_density_est_gcm3").alias("rho_est"), F.col("comp_metal_fraction").alias("metal"), F.col("comp_silicate_fraction").alias("silicate"), F.col("comp_carbon_fraction").alias("carbon"), F.col("comp_ice_fraction").alias("ice"))


@query("n05_pgm_factor", sql("enriched", "SELECT designation, pgm FROM n3"))
def _(spark, sf):
    return stage(spark, sf, "enriched").select("designation", F.col("comp_pgm_enrichment").alias("pgm"))


_DIMS = (
    [
        values("cls", "class, grp, density, metal, silicate, carbon, ice, pgm", dims.class_rows()),
        values("sh", "class, grp, phase, share", dims._rows(dims.SHARES)),
        values("ac", "class, phase, fraction", dims._rows(dims.ACCESSORIES)),
        values("rf", "class, phase, finer, share", dims._rows(dims.REFINEMENTS)),
        values("xa", "class, phase, fraction", dims._rows(dims.REFINED_ACCESSORIES)),
        values("ph", "phase, grp, place", dims.phase_order()),
        values("xc", "class, member, n", [(a, m, n) for a, ns in dims.X_COUNTS.items() for m, n in zip("PME", ns)]),
        """typed AS (SELECT class, phase, sum(f) AS f FROM (SELECT s.class, s.phase, share*CASE s.grp WHEN 'metal' THEN metal WHEN 'silicate' THEN silicate WHEN 'carbon' THEN carbon ELSE ice END AS f FROM sh s JOIN cls USING (class) UNION ALL SELECT * FROM ac) WHERE f > 0 GROUP BY 1, 2)""",
        "mm AS (SELECT xc.class, member, n*density AS mass, sum(n*density) OVER (PARTITION BY xc.class) AS total FROM xc JOIN cls c ON c.class = member)",
        "mx AS (SELECT mm.class, t.phase, ph.grp, sum(mass*f/total) AS f FROM mm JOIN typed t ON t.class = member JOIN ph ON ph.phase = t.phase GROUP BY ALL)",
        """mix AS (SELECT x.class, x.phase, CASE WHEN x.grp = 'accessory' THEN x.f ELSE x.f/sum(x.f) OVER (PARTITION BY x.class, x.grp)*CASE x.grp WHEN 'metal' THEN metal WHEN 'silicate' THEN silicate WHEN 'carbon' THEN carbon ELSE ice END END AS f FROM mx x JOIN cls c ON c.class = x.class)""",
        "pf AS (SELECT * FROM typed UNION ALL SELECT * FROM mix WHERE f > 0)",
        "br AS (SELECT mm.class, member, t.phase, mass*f AS w, mass/total AS part FROM mm JOIN typed t ON t.class = member)",
        "mrf AS (SELECT class, phase, finer, sum(v)/max(den) AS share FROM (SELECT br.class, br.phase, coalesce(rf.finer, br.phase) AS finer, w*coalesce(rf.share, 1) AS v, (SELECT sum(b.w) FROM br b WHERE b.class = br.class AND b.phase = br.phase) AS den FROM br LEFT JOIN rf ON rf.class = member AND rf.phase = br.phase) GROUP BY 1, 2, 3)",
        "df AS (SELECT class, phase, sum(f) AS f FROM (SELECT pf.class, coalesce(r.finer, pf.phase) AS phase, pf.f*coalesce(r.share, 1) AS f FROM pf LEFT JOIN (SELECT * FROM rf UNION ALL SELECT * FROM mrf) r ON r.class = pf.class AND r.phase = pf.phase UNION ALL SELECT * FROM xa) WHERE f > 0 GROUP BY 1, 2)",
    ]
)


def _by_phase(spark, sf, table_) -> DataFrame:
    """Bodies and mass per class and phase: the dimension joined to the catalog."""
    bodies = stage(spark, sf, "enriched").groupBy(F.col("comp_class").alias("class")).agg(F.count("*").alias("n"))
    return bodies.join(F.broadcast(table_), "class").select("class", "phase", r("fraction", 9).alias("fraction"), "n")


_COMP = "comps AS (SELECT comp AS class, count(*) AS n FROM fin GROUP BY 1)"


@query("n06_phase_fractions", sql("enriched", "SELECT pf.class, phase, round(f, 9) AS fraction, n FROM pf JOIN comps USING (class) WHERE pf.class NOT IN ('X', 'Xc')", _COMP, *_DIMS))
def _(spark, sf):
    return _by_phase(spark, sf, minerals.typed_fractions(spark))


@query("n07_mixture", sql("enriched", "SELECT mix.class, phase, round(f, 9) AS fraction, n FROM mix JOIN comps USING (class) WHERE f > 0", _COMP, *_DIMS))
def _(spark, sf):
    return _by_phase(spark, sf, minerals.mixture_fractions(spark))


@query("n08_refinement", sql("enriched", "SELECT df.class, phase, round(f, 9) AS fraction, n FROM df JOIN comps USING (class)", _COMP, *_DIMS))
def _(spark, sf):
    return _by_phase(spark, sf, minerals.detailed_fractions(spark))


_PLACED = "SELECT designation, '{kind}' AS kind, row_number() OVER (PARTITION BY designation ORDER BY place) AS at, t.phase, round(t.f, 9) AS fraction FROM fin JOIN {t} t ON t.class = comp JOIN ph ON ph.phase = t.phase"


@query("n09_phases_json", sql("enriched", _PLACED.format(kind="coarse", t="pf") + " UNION ALL " + _PLACED.format(kind="fine", t="df"), *_DIMS))
def _(spark, sf):
    # The objects read back: every phase with its place in the text.
    d = stage(spark, sf, "enriched")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("text")) for k, c in (("coarse", "comp_phases"), ("fine", "comp_phases_detailed"))])
    texts = d.select("designation", F.explode(kinds).alias("x")).select("designation", "x.kind", F.from_json("x.text", "map<string,double>").alias("m"))
    each = texts.select("designation", "kind", F.posexplode(F.map_entries("m")).alias("at", "e"))
    return each.select("designation", "kind", (F.col("at") + 1).cast("long").alias("at"), F.col("e.key").alias("phase"), r("e.value", 9).alias("fraction"))


@query("n04_minerals", sql("enriched", "SELECT designation, minerals FROM fin LEFT JOIN (SELECT pf.class, string_agg(pf.phase, ',' ORDER BY place) AS minerals FROM pf JOIN ph ON ph.phase = pf.phase GROUP BY 1) x ON x.class = comp", *_DIMS))
def _(spark, sf):
    return stage(spark, sf, "enriched").select("designation", F.array_join("comp_minerals", ",").alias("minerals"))


@query("n10_reconcile", sql("enriched", "SELECT designation, round(d, 6) AS d, round(rho, 6) AS rho, round(mass/1e15, 3) AS mass, rho_meas, mass_meas, d_src, m_out, m_prov FROM fin"))
def _(spark, sf):
    d = stage(spark, sf, "enriched")
    return d.select("designation", r("diameter_km").alias("d"), r("density_gcm3").alias("rho"), mass("estimated_mass_kg").alias("mass"), F.col("density_measured").alias("rho_meas"), F.col("mass_measured").alias("mass_meas"), F.col("diameter_source").alias("d_src"), F.col("mass_screened_out").alias("m_out"), F.col("mass_provider").alias("m_prov"))


# --- calibration ----------------------------------------------------------------------

_OK = "p > 0 AND p < 1"
_WITHX = "cal AS (SELECT *, a AS au FROM fin)"


@query("e13_albedo_by_class", sql("enriched", f"SELECT cls_ AS class, round(median(p), 6) AS median, count(*) AS n FROM fin WHERE c_src = 'source' AND {_OK} GROUP BY 1 HAVING count(*) >= 5"))
def _(spark, sf):
    return calibrate.albedo_by_class(stage(spark, sf, "enriched")).withColumn("median", r("median"))


def _bands_sql(name: str, rows: list[tuple], neo: str) -> str:
    return sql("enriched", f"SELECT b.a_min, round(median(p), 6) AS median, count(p) AS n FROM b LEFT JOIN (SELECT a, p FROM fin WHERE coalesce(is_neo, false) = {neo} AND {_OK} AND p_prov = 'fits') x ON a >= a_min AND a < a_max GROUP BY 1", values("b", "a_min, a_max, alb", rows))


@query("e14_albedo_by_band", _bands_sql("b", dims.BELT_BANDS, "false"))
def _(spark, sf):
    return calibrate.albedo_by_band(stage(spark, sf, "enriched"), dims.bands(spark, False), False, "fits").withColumn("median", r("median"))


@query("e15_albedo_beyond", sql("enriched", f"SELECT b.h_max, round(median(p), 6) AS median, count(p) AS n FROM (SELECT h_max, coalesce(lag(h_max) OVER (ORDER BY h_max), -1e9) AS h_min FROM hb) b LEFT JOIN (SELECT h, p FROM fin WHERE a >= 5.5 AND {_OK}) x ON h > h_min AND h <= b.h_max GROUP BY 1", values("hb", "h_max, alb", dims.H_BANDS)))
def _(spark, sf):
    return calibrate.albedo_beyond(stage(spark, sf, "enriched"), dims.h_bands(spark)).withColumn("median", r("median"))


@query("e16_albedo_overall", sql("enriched", f"SELECT round(median(p) FILTER ({_OK} AND p_prov = 'orbits'), 6) AS median FROM fin"))
def _(spark, sf):
    return calibrate.albedo_overall(stage(spark, sf, "enriched"), "orbits").select(r("median").alias("median"))


@query("e17_drift", sql("enriched", f"SELECT coalesce(x.class, ca.class) AS class, round(now, 6) AS now, albedo AS committed, round(abs(now/albedo - 1), 6) AS drift, CASE WHEN albedo IS NULL THEN 'not in the table' WHEN now IS NULL THEN 'unfillable' WHEN abs(now/albedo - 1) > 2e-2 THEN 'drifted' ELSE 'ok' END AS status FROM (SELECT cls_ AS class, median(p) AS now FROM fin WHERE c_src = 'source' AND {_OK} GROUP BY 1 HAVING count(*) >= 5) x FULL JOIN ca ON ca.class = x.class"))
def _(spark, sf):
    out = calibrate.drift(calibrate.albedo_by_class(stage(spark, sf, "enriched")), dims.class_albedo(spark))
    return out.withColumns({"now": r("now"), "drift": r("drift")})


_BODIES = "bod AS (SELECT designation, cls_, comp, rho, p, rho*(mass_s/mass) AS sg FROM fin WHERE c_src IN ('source', 'tholen') AND mass_meas AND rho_meas AND mass_s/mass > 0 AND mass_s/mass <= 2e-1 AND a < 5.5)"


@query("e18_qualified_sample", sql("enriched", "SELECT designation, cls_ AS class, round(rho, 6) AS rho, round(sg, 6) AS sigma FROM bod", _BODIES))
def _(spark, sf):
    return calibrate.measured_bodies(stage(spark, sf, "enriched")).select("designation", F.col("spectral_type").alias("class"), r("density_gcm3").alias("rho"), r("sigma").alias("sigma"))


_STATS = "count(*) AS n, round(avg(rho), 6) AS mean, round(stddev_samp(rho), 6) AS sd, round(median(rho), 6) AS median, round(sum(rho/(sg*sg))/sum(1/(sg*sg)), 6) AS weighted"


@query("e19_density_stats", sql("enriched", f"SELECT comp AS comp_class, {_STATS} FROM bod GROUP BY 1", _BODIES))
def _(spark, sf):
    out = calibrate.density_stats(calibrate.measured_bodies(stage(spark, sf, "enriched")), "comp_class")
    return out.withColumns({c: r(c) for c in ("mean", "sd", "median", "weighted")})


@query("e20_x_bins", sql("enriched", f"SELECT CASE WHEN p < 1e-1 THEN 'P' WHEN p < 3e-1 THEN 'M' ELSE 'E' END AS bin, {_STATS} FROM bod WHERE cls_ LIKE 'X%' AND {_OK} GROUP BY 1", _BODIES))
def _(spark, sf):
    out = calibrate.x_bins(calibrate.measured_bodies(stage(spark, sf, "enriched")))
    return out.withColumns({c: r(c) for c in ("mean", "sd", "median", "weighted")})


_XS = f"xs AS (SELECT cls_ AS class, count(*) FILTER (p < 1e-1) AS p, count(*) FILTER (p >= 1e-1 AND p < 3e-1) AS m, count(*) FILTER (p >= 3e-1) AS e FROM fin WHERE cls_ IN ('X', 'Xc') AND {_OK} AND a < 5.5 GROUP BY 1)"


@query("e21_x_split", sql("enriched", "SELECT * FROM xs", _XS))
def _(spark, sf):
    return calibrate.x_split_counts(stage(spark, sf, "enriched"))


@query("e22_mixture_check", sql("enriched", "SELECT xs.class, round((p*1.2 + m*3.9 + e*3.2)/(p + m + e), 6) AS mixture, density, CASE WHEN abs((p*1.2 + m*3.9 + e*3.2)/(p + m + e) - density) > 5e-2 THEN 'off' ELSE 'ok' END AS status FROM xs JOIN cls ON cls.class = xs.class", _XS))
def _(spark, sf):
    return calibrate.mixture_check(calibrate.x_split_counts(stage(spark, sf, "enriched")), dims.classes(spark)).withColumn("mixture", r("mixture"))


@query("e22_class_verdict", sql("enriched", """SELECT comp_class, n, density, CASE WHEN n < 3 THEN 'not judged' WHEN high THEN 'too high' WHEN low AND reason IS NULL THEN 'too low' ELSE 'ok' END AS verdict,
 CASE WHEN low AND n >= 3 THEN reason END AS reason FROM (SELECT s.comp AS comp_class, n, density, density > mean + 2*sd AS high, density < mean - 2*sd AS low, reason
 FROM (SELECT comp, count(*) AS n, avg(rho) AS mean, stddev_samp(rho) AS sd FROM bod GROUP BY 1) s JOIN cls ON cls.class = s.comp LEFT JOIN why ON why.class = s.comp)""", _BODIES, values("why", "class, reason", list(dims.BELOW_BECAUSE.items()))))
def _(spark, sf):
    stats = calibrate.density_stats(calibrate.measured_bodies(stage(spark, sf, "enriched")), "comp_class")
    return calibrate.class_verdict(stats, dims.classes(spark), dims.below_because(spark))


@query("e23_distinct_entities", "SELECT l_returnflag AS status, count(*) AS n_rows, count(DISTINCT l_partkey) AS n_bodies FROM lineitem GROUP BY 1")
def _(spark, sf):
    from orrery.operators import refs

    return refs.summary(table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("status"), F.col("l_partkey").alias("designation")))


# --- query surface -------------------------------------------------------------------


@query("q01_lookup", sql("merged", "SELECT designation FROM m WHERE contains(upper(designation), 'E1') OR coalesce(contains(upper(name), 'E1'), false) OR contains(upper(provisional_designation), 'E1')"))
def _(spark, sf):
    return lookup.lookup(stage(spark, sf, "merged"), " e1 ").select("designation")


@query("q02_region", sql("merged", "SELECT designation FROM m WHERE semi_major_axis_au >= 2e0 AND semi_major_axis_au < 25e-1"))
def _(spark, sf):
    return lookup.in_region(stage(spark, sf, "merged"), 2.0, 2.5).select("designation")


@query("q03_groups", sql("enriched", "SELECT designation, comp_group FROM fin WHERE comp_group IN ('C-complex', 'D-type')"))
def _(spark, sf):
    return lookup.in_groups(stage(spark, sf, "enriched"), "C-complex", "D-type").select("designation", "comp_group")


@query("q04_measured_only", sql("derived", "SELECT designation FROM dv WHERE NOT d_est"))
def _(spark, sf):
    return lookup.measured_only(stage(spark, sf, "derived")).select("designation")


@query("q05_sort", sql("merged", "SELECT designation, semi_major_axis_au AS a FROM m ORDER BY a, designation"))
def _(spark, sf):
    return lookup.sorted_for_write(stage(spark, sf, "merged").select("designation", F.col("semi_major_axis_au").alias("a")), "a", "designation")


@query("q06_head", sql("merged", "SELECT designation FROM m ORDER BY designation LIMIT 25"))
def _(spark, sf):
    return lookup.head(stage(spark, sf, "merged").select("designation"), 25, "designation")


@query("q07_top_share", sql("enriched", "SELECT designation, round(mass/1e15, 3) AS mass, round(mass/(SELECT sum(mass) FROM fin), 9) AS share FROM fin ORDER BY mass DESC, designation LIMIT 10"))
def _(spark, sf):
    top = lookup.top_with_share(stage(spark, sf, "enriched").select("designation", "estimated_mass_kg"), "estimated_mass_kg", 10)
    return top.select("designation", mass("estimated_mass_kg").alias("mass"), r("share", 9).alias("share"))


@query("q08_union_all", sql("fx", "SELECT designation AS k FROM fx_orbits UNION ALL SELECT designation FROM fx_best UNION ALL SELECT name FROM fx_compendium"))
def _(spark, sf):
    v = fixtures.views(spark, sf)
    k = lambda t, c: v[t].select(F.col(c).alias("k"))
    return k("fx_orbits", "designation").unionByName(k("fx_best", "designation")).unionByName(k("fx_compendium", "name"))


@query("q09_duplicates", "SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _(spark, sf):
    return lookup.duplicated(table(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query("catalog_flagship", sql("resolved", "SELECT designation, round(d, 6) AS diameter_km, d_prov AS provider, d_n AS n_sources, round(d_spread, 6) AS spread, CASE WHEN d_n >= 2 THEN d_spread <= 1e-1 END AS agree FROM rs"))
def flagship(spark, sf):
    """One row per body: diameter, provider, sources, spread, agreement."""
    views = fixtures.views(spark, sf)
    out = catalog.resolved(views, spark)
    return out.select("designation", r("diameter_km").alias("diameter_km"), F.col("diameter_provider").alias("provider"), F.col("diameter_n_sources").alias("n_sources"), r("diameter_spread").alias("spread"), F.col("diameter_sources_agree").alias("agree"))
