"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the demo world projected from the benchmark tables of
``sf_dir`` and runs the library's own operators over all of it.  Arrays are
returned as ``a|b|c`` text so results compare with the SQL oracle
(:mod:`rightsweave.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rightsweave.functions.arrays import key_string
from rightsweave.operators import pairs
from rightsweave.plans import chain_table, chains, contracts, dated, jobs, restitution, territories
from rightsweave.session import discard_unread, tracked
from rightsweave.sources import world as W

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _dec(c: Column) -> Column:
    return c.cast("decimal(18,4)").cast("string")


def _assignors_text(c: str = "assignors") -> Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x["catalog"].cast("string"), x["role"], _dec(x["pct_publisher"]), _dec(x["pct_creator"]),
        F.array_join(x["right_types"], "+"))), ";")


def _assignees_text(c: str = "assignees") -> Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x["catalog"].cast("string"), x["role"], x["manager"].cast("string"))), ";")


def chain_text(df: DataFrame, *extra: Column) -> DataFrame:
    """Comparable projection of a chain table."""
    return df.select(
        key_string("chain").alias("chain_key"), _assignors_text().alias("assignors_key"),
        _assignees_text().alias("assignees_key"),
        "contract_type", "start_date", "end_date", "assignable", "biem", "idtercess", "fledit",
        key_string("genre_incl").alias("genre_incl_key"), key_string("genre_excl").alias("genre_excl_key"),
        key_string("catalog_incl").alias("catalog_incl_key"),
        key_string("catalog_excl").alias("catalog_excl_key"),
        key_string("work_incl").alias("work_incl_key"), key_string("work_excl").alias("work_excl_key"),
        key_string("territories").alias("territories_key"),
        *extra,
    )


def _world(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return W.load_world(spark, sf_dir)


def _assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract base of the world's tables."""
    t = _world(spark, sf_dir)
    terr = jobs.territory_tables(t)
    return contracts.contract_base(t, terr["territories_by_id_tercmplx"], W.CONSULT_DATE)


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract base written once, with row ids (it is read several times downstream)."""
    with tracked() as paths:
        base = chains.with_row_id(_assembled(spark, sf_dir))
    discard_unread(base, paths)
    return base


# ----------------------------------------------------------------- territories
@query
def ter_closure(spark, sf_dir):
    """Transitive closure of the territory hierarchy (semi-naive rounds)."""
    return territories.closure(_world(spark, sf_dir)["gpeter"])


@query
def ter_leaves(spark, sf_dir):
    """Leaf territories (anti join of children against parents)."""
    return territories.leaves(_world(spark, sf_dir)["gpeter"])


@query
def ter_leaf_sets(spark, sf_dir):
    """Territory -> leaf countries."""
    sets = territories.leaf_sets(_world(spark, sf_dir)["gpeter"])
    return sets.select("cdepaysiso4n", key_string("cdepaysiso4n_fils").alias("leaves_key"),
                       F.size("cdepaysiso4n_fils").alias("n_leaves"))


def _fold_out(df: DataFrame) -> DataFrame:
    return df.select("idtercmplx", key_string("territoires").alias("countries_key"),
                     F.size("territoires").alias("n_countries"))


@query
def ter_fold(spark, sf_dir):
    """Complex territories folded from ordered include/exclude elements."""
    t = _world(spark, sf_dir)
    sets = territories.leaf_sets(t["gpeter"])
    return _fold_out(territories.fold(t["eltter"], sets))


@query
def ter_fold_window(spark, sf_dir):
    """Same fold through ordered windows per (territory, leaf)."""
    t = _world(spark, sf_dir)
    sets = territories.leaf_sets(t["gpeter"])
    return _fold_out(territories.fold_window(t["eltter"], sets))


# ------------------------------------------------------------------- contracts
@query
def flt_contract_validity(spark, sf_dir):
    """Contracts in force at the consultation date, end date overridden."""
    c = contracts.valid_contracts(_world(spark, sf_dir)["contrat"], W.CONSULT_DATE)
    return c.select("idctr", "numctr", "cdetypctr", "indcsbl", "datdbtctr", "datfinctr", "idtercmplx")


@query
def asm_assignors(spark, sf_dir):
    """Assignor list per contract (details, catalogs, percents, roles)."""
    t = _world(spark, sf_dir)
    a = contracts.assignors(t["detcedant"], t["detcedantcatal"], t["pcttypdrt"], t["partpt"])
    return chain_text_part(a, "assignors")


@query
def asm_assignees(spark, sf_dir):
    """Assignee list per contract."""
    a = contracts.assignees(_world(spark, sf_dir)["detcess"])
    return chain_text_part(a, "assignees")


def chain_text_part(df: DataFrame, column: str) -> DataFrame:
    """Comparable projection of one per-contract list (``assignors`` or ``assignees``)."""
    txt = _assignors_text(column) if column == "assignors" else _assignees_text(column)
    return df.select("idctr", txt.alias(f"{column}_key"), F.size(column).alias(f"n_{column}"))


@query
def asm_restrictions(spark, sf_dir):
    """Restriction sets per contract."""
    t = _world(spark, sf_dir)
    r = contracts.restrictions(t["restrctr"], t["restrgenre"], t["restroeuv"], t["restrpers"])
    cols = ["genre_incl", "genre_excl", "catalog_incl", "catalog_excl", "work_incl", "work_excl"]
    return r.select("idctr", *[key_string(c).alias(f"{c}_key") for c in cols])


@query
def asm_contract_base(spark, sf_dir):
    """Level 0: one wide row per valid contract."""
    return chain_text(_assembled(spark, sf_dir).dropDuplicates())


# ---------------------------------------------------------------------- chains
@query
def jn_array_overlap(spark, sf_dir):
    """Contract pairs linked by assignee/assignor catalog overlap."""
    return chains.contract_links(_base(spark, sf_dir))


@query
def jn_surviving_pairs(spark, sf_dir):
    """Contract pairs linked through a catalog whose chain is neither void nor without territory."""
    sides = chains.surviving_sides(_base(spark, sf_dir))
    return sides.select(F.get("a.chain", F.lit(0)).alias("from_ctr"), F.get("b.chain", F.lit(0)).alias("to_ctr")).distinct()


@query
def chn_level1(spark, sf_dir):
    """Level 1 chains (overlap join, combined, void chains dropped)."""
    base = _base(spark, sf_dir)
    return chain_text(chains.overlap_level(base))


@query
def chn_levels(spark, sf_dir):
    """Every level of the pivot-mode chain table, with its level number."""
    base = _base(spark, sf_dir)
    parts = chains.levels(base, W.MAX_DEPTH)
    out = None
    for i, p in enumerate(parts):
        part = chain_text(p).withColumn("level", F.lit(i))
        out = part if out is None else out.unionByName(part)
    return out


@query
def chn_build(spark, sf_dir):
    """Chain table: levels 0..4 unioned and deduplicated (pivot mode)."""
    base = _base(spark, sf_dir)
    return chain_text(chains.build(base, W.MAX_DEPTH))


@query
def chn_paths(spark, sf_dir):
    """Chain table in clean path mode."""
    base = _base(spark, sf_dir)
    return chain_text(chains.paths(base, W.MAX_DEPTH))


@query
def chn_flatten(spark, sf_dir):
    """Chains in scalar shape: one row per assignor entry, right type, assignee entry."""
    base = _base(spark, sf_dir)
    flat = chains.flatten(chains.build(base, W.MAX_DEPTH))
    return flat.select(
        key_string("chain").alias("chain_key"), "assignor_catalog", "assignor_role", "pct_publisher",
        "pct_creator", "right_type", "assignee_catalog", "assignee_role", "assignee_manager",
        "contract_type", "start_date", "end_date", "assignable",
        key_string("territories").alias("territories_key"), key_string("work_excl").alias("work_excl_key"),
    )


@query
def chn_overlap_closure(spark, sf_dir):
    """Contracts reachable through overlap links, least hops, with the catalogs at both ends."""
    reach = chains.reach_ends(_base(spark, sf_dir))
    return reach.select("from_ctr", "to_ctr", "hops", key_string("assignor_catalogs").alias("assignor_catalogs_key"),
                        key_string("assignee_catalogs").alias("assignee_catalogs_key"))


# ----------------------------------------------------------------- restitution
def _restitution_inputs(spark, sf_dir):
    t = _world(spark, sf_dir)
    terr = jobs.territory_tables(t)
    flat = jobs.flat_chain_table(t, terr, W.CONSULT_DATE, W.MAX_DEPTH)
    req = restitution.single_request(t["oeuv"].select("ide12"), W.COUNTRY, W.RIGHT_TYPE, W.CONSULT_DATE)
    keys = restitution.static_keys(t, terr["territories_by_id_tercmplx"], req, keep_territories=False)
    return t, flat, keys


@query
def rst_static_keys(spark, sf_dir):
    """Static key set: owners of all works for country 3, right type DE."""
    t = _world(spark, sf_dir)
    terr = jobs.territory_tables(t)
    req = restitution.single_request(t["oeuv"].select("ide12"), W.COUNTRY, W.RIGHT_TYPE, W.CONSULT_DATE)
    keys = restitution.static_keys(t, terr["territories_by_id_tercmplx"], req)
    return keys.select(
        "idoeuv", "ide12", "cdetypdrtsacem", "numpers", "numcatal", "cle", "cdecategadsacem", "let",
        "cde_motif_mise_en_attente", "idtercmplx", key_string("territoires").alias("territoires_key"),
        "cedant", "gestnr", "priort",
    )


@query
def rst_match(spark, sf_dir):
    """Owner rows matched to chains; longest chains of highest priority kept."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    m = restitution.match_chains(keys, flat)
    return m.select(
        "ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine", "numcatal_ayant_droit_final",
        "role_ad_final", key_string("chaine_contrats").alias("chaine_contrats"), "pct_editeur",
        "pct_createur", "cle", "gestnr", *(key_string(c).alias(f"{c}_key") for c in restitution.RESTRICTIONS),
    )


@query
def rst_shares(spark, sf_dir):
    """Ceded / remaining / final shares before exclusions and residuals."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    s = restitution.shares(restitution.match_chains(keys, flat))
    return s.select(
        "ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine", "numcatal_ayant_droit_final",
        "role_ad_final", key_string("chaine_contrats").alias("chaine_contrats"), "cle", "gestnr",
        F.round("pct_cede", 4).alias("pct_cede"), F.round("pct_restant", 4).alias("pct_restant"),
        F.round("pct_final", 4).alias("pct_final"),
    )


@query
def rst_restitution(spark, sf_dir):
    """Flagship: full restitution of every work for (country 3, DE, 2001-01-01)."""
    with tracked() as paths:
        _, flat, keys = _restitution_inputs(spark, sf_dir)
    return restitution.as_text(restitution.restitution(flat, keys, release=paths))


@query
def rst_restitution_strict(spark, sf_dir):
    """Restitution with the longest-chain filter separated per work, letter and origin."""
    with tracked() as paths:
        _, flat, keys = _restitution_inputs(spark, sf_dir)
    return restitution.as_text(restitution.restitution(flat, keys, strict=True, release=paths))


@query
def rst_restitution_batch(spark, sf_dir):
    """Many requests in one job: every work under each of five contexts."""
    t = _world(spark, sf_dir)
    with tracked() as paths:
        terr = jobs.territory_tables(t)
        flat = jobs.flat_chain_table(t, terr, W.CONSULT_DATE, W.MAX_DEPTH)
        req = t["requests"].join(t["contexts"], "num_contexte")
        keys = restitution.static_keys(t, terr["territories_by_id_tercmplx"], req, ["num_contexte"],
                                       keep_territories=False)
    return restitution.as_text(restitution.restitution(flat, keys, ["num_contexte"], release=paths))


@query
def rst_restitution_dates(spark, sf_dir):
    """Every work under five contexts with consultation dates of their own, in one run over date segments."""
    t = _world(spark, sf_dir)
    own = F.create_map(*(F.lit(x) for pair in W.CONTEXT_DATES.items() for x in pair))
    req = t["requests"].join(t["contexts"], "num_contexte").withColumn(
        "date_consultation", F.to_date(F.element_at(own, F.col("num_contexte"))))
    return restitution.as_text(dated.restitution_by_date(t, req, W.MAX_DEPTH, ["num_contexte"]))


@query
def chn_incremental(spark, sf_dir):
    """The chain table after three rounds of changes: a year's contracts corrected, and later ones added."""
    base = _base(spark, sf_dir)
    year = F.year("start_date")
    earlier = base.where(year < 1997).withColumn("assignable", F.when(year == 1996, 1).otherwise(F.col("assignable")))
    path = _scratch(spark, "chain_table")
    chain_table.create(earlier, W.MAX_DEPTH, path)
    for change in (year == 1996, year == 1997, year > 1997):
        rows = base.where(change)
        chain_table.apply_changes(spark, path, rows, rows.select(F.get(F.col("chain"), 0).alias("numctr")), W.MAX_DEPTH)
    return chain_text(chain_table.chain_rows(spark, path, base))


# ------------------------------------------------------------ sources / sinks
def _scratch(spark: SparkSession, name: str) -> str:
    import uuid

    from rightsweave.session import scratch_dir
    return f"{scratch_dir(spark)}/rightsweave/{uuid.uuid4().hex}/{name}"


@query
def src_projected_read(spark, sf_dir):
    """Registry-driven read: projection pushed into the scan, then dedup."""
    from rightsweave.sources import io
    reg = {"lineitem": {"path": f"{sf_dir}/lineitem.parquet",
                        "columns": ["l_orderkey", "l_partkey", "l_returnflag"]}}
    return io.read_registry(spark, reg)["lineitem"]


@query
def src_parse_pipe_array(spark, sf_dir):
    """Golden-format CSV written from lineitem, read back: ``a | b`` -> array<int>."""
    from rightsweave.sources import io
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    golden = li.select(
        F.col("l_partkey").alias("ide12"),
        F.when(F.col("l_linenumber") % 3 == 1, "A").when(F.col("l_linenumber") % 3 == 2, "B").alias("lettrage"),
        F.col("l_orderkey").alias("numcatal_cedant_origine"),
        F.col("l_returnflag").alias("role_ad_origine"),
        F.col("l_suppkey").alias("numcatal_ayant_droit_final"),
        F.col("l_linestatus").alias("role_ad_final"),
        F.concat_ws(" | ", F.col("l_orderkey").cast("string"),
                    (F.col("l_orderkey") + F.col("l_linenumber")).cast("string")).alias("chaine_contrats"),
        F.col("l_quantity").alias("cle"),
    )
    path = _scratch(spark, "golden_csv")
    golden.write.option("header", True).csv(path)
    back = io.read_expected(spark, path)
    return back.select(
        "ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine", "numcatal_ayant_droit_final",
        "role_ad_final", key_string("chaine_contrats").alias("chain_key"),
        F.size("chaine_contrats").alias("chain_len"), "cle",
    )


@query
def src_csv_rejects(spark, sf_dir):
    """Orders as CSV lines, some short, long or badly typed, loaded with the declared schema: good rows and rejects."""
    from rightsweave.sources import io
    key, day = F.col("o_orderkey"), F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")
    line = (F.when(key % 97 == 0, F.concat_ws(",", key, "o_custkey"))
            .when(key % 89 == 0, F.concat_ws(",", key, "o_custkey", day, F.lit("more")))
            .when(key % 83 == 0, F.concat_ws(",", key, F.lit("x"), F.lit("never")))
            .otherwise(F.concat_ws(",", key, "o_custkey", day)))
    path = _scratch(spark, "orders_lines")
    spark.read.parquet(f"{sf_dir}/orders.parquet").select(line.alias("line")).write.text(path)
    loaded = io.load_csv(spark, path, _scratch(spark, "orders_typed"),
                         {"o_orderkey": "long", "o_custkey": "long", "o_orderdate": "date"}, header=False)
    rejected = loaded.rejects.select(
        F.substring_index("line", ",", 1).cast("long").alias("o_orderkey"), F.lit(None).cast("long").alias("o_custkey"),
        F.lit(None).cast("date").alias("o_orderdate"), F.array_join("reasons", "; ").alias("reasons"))
    return loaded.rows.withColumn("reasons", F.lit(None).cast("string")).unionByName(rejected)


@query
def snk_partitioned_roundtrip(spark, sf_dir):
    """Percent table written partitioned by right type and read back, every partition."""
    from rightsweave.sources import io
    path = _scratch(spark, "pcttypdrt_by_right")
    io.write_parquet(_world(spark, sf_dir)["pcttypdrt"], path, partition_by="cdetypdrtsacem")
    back = spark.read.parquet(path)
    return back.select("idpcttypdrt", "idclauspartcl", "pct", "cdetypdrtsacem")


@query
def snk_snapshots(spark, sf_dir):
    """Orders by two interleaved writers and a cut-off one: what each committed version holds."""
    from rightsweave.sources import snapshots
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("status"))
    root = _scratch(spark, "orders_snapshots")
    late = snapshots.stage(orders, root, "status")
    early = snapshots.stage(orders.where("o_orderkey % 2 = 0"), root, "status")
    snapshots.stage(orders.where("o_orderkey % 3 = 0"), root, "status")  # never committed
    versions = [snapshots.commit(spark, root, s).version for s in (early, late)]
    assert snapshots.newest(spark, root).snapshot == late.snapshot
    return snapshots.read(spark, root, versions[0]).withColumn("version", F.lit(versions[0])).unionByName(
        snapshots.read(spark, root).withColumn("version", F.lit(versions[1])))


@query
def snk_csv_to_parquet(spark, sf_dir):
    """Customer rows through CSV (untyped) into an appended Parquet folder."""
    from rightsweave.sources import io
    cust = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    csv_path = _scratch(spark, "customer_csv")
    cust.write.option("header", True).csv(csv_path)
    return io.csv_to_parquet(spark, csv_path, _scratch(spark, "customer_parquet"))


@query
def snk_compute_if_absent(spark, sf_dir):
    """Complex-territory table computed once, written, re-read (compute-if-absent)."""
    from rightsweave.sources import io
    t = _world(spark, sf_dir)
    path = _scratch(spark, "territories_by_id_tercmplx")

    def compute():
        return territories.fold(t["eltter"], territories.leaf_sets(t["gpeter"]))

    first = io.read_or_compute(spark, path, compute)
    again = io.read_or_compute(spark, path, compute)  # present now: read only
    assert again.columns == first.columns
    return _fold_out(again)


# ------------------------------------------------------- filters / projections
@query
def flt_contract_validity_lenient(spark, sf_dir):
    """Lenient validity (``second <> 1``, no id test), bookkeeping columns kept."""
    c = contracts.valid_contracts(_world(spark, sf_dir)["contrat"], W.CONSULT_DATE, lenient=True)
    return c.select("idctr", "numctr", "datdbtctr", "datfinctr", "datdbtsys", "datfinsys", "second",
                    "cdestatutctr")


@query
def prj_end_override(spark, sf_dir):
    """End-date override on every contract (no validity filter)."""
    c = _world(spark, sf_dir)["contrat"]
    return c.select("idctr", F.col("datfinctr").alias("datfinctr_raw"),
                    contracts.overridden_end().alias("datfinctr"))


@query
def flt_active_works(spark, sf_dir):
    """Works valid at the consultation date (strict bounds, open end)."""
    t = _world(spark, sf_dir)
    req = restitution.single_request(t["oeuv"].select("ide12"), W.COUNTRY, W.RIGHT_TYPE, W.CONSULT_DATE)
    return restitution.active_works(t["oeuv"], req).select("idoeuv", "ide12").distinct()


@query
def flt_territory_contains(spark, sf_dir):
    """Complex territories whose country set contains country 3."""
    t = _world(spark, sf_dir)
    sets = territories.fold(t["eltter"], territories.leaf_sets(t["gpeter"]))
    return territories.contains_country(sets, W.COUNTRY).select("idtercmplx")


@query
def prj_suffix(spark, sf_dir):
    """Every assignor-detail column suffixed except the keys."""
    from rightsweave.operators.projections import suffix_columns
    return suffix_columns(_world(spark, sf_dir)["detcedant"], "cedant", keep=("idctr", "iddetcedant"))


@query
def prj_prefix(spark, sf_dir):
    """Every assignee column prefixed."""
    from rightsweave.operators.projections import prefix_columns
    return prefix_columns(_world(spark, sf_dir)["detcess"], "detcess")


@query
def prj_restriction_gate(spark, sf_dir):
    """Whether work restrictions apply to each valid contract, and the gated sets."""
    t = _world(spark, sf_dir)
    c = contracts.valid_contracts(t["contrat"], W.CONSULT_DATE)
    a = contracts.assignors(t["detcedant"], t["detcedantcatal"], t["pcttypdrt"], t["partpt"])
    r = contracts.restrictions(t["restrctr"], t["restrgenre"], t["restroeuv"], t["restrpers"])
    gate = contracts.work_restriction_applies()
    j = c.join(a, "idctr").join(r, "idctr", "left")
    return j.select(
        "idctr", gate.alias("applies"),
        key_string(contracts.or_empty(F.when(gate, F.col("work_incl")), "bigint")).alias("work_incl_key"),
        key_string(contracts.or_empty(F.when(gate, F.col("work_excl")), "bigint")).alias("work_excl_key"),
    )


@query
def agg_distinct_rows(spark, sf_dir):
    """Distinct (role, catalog, person) of the work participants."""
    return contracts.participant_roles(_world(spark, sf_dir)["partpt"])


# ----------------------------------------------------------------------- joins
@query
def jn_creator_pct_left(spark, sf_dir):
    """Assignor details with publisher (inner) and creator (left, two keys) percents."""
    t = _world(spark, sf_dir)
    p = contracts.assignor_percents(t["detcedant"], t["detcedantcatal"], t["pcttypdrt"])
    return p.select("idctr", "numpers", "numcatal", "pct_publisher", "pct_creator",
                    key_string("right_types").alias("right_types_key"))


@query
def jn_salted_equals_plain(spark, sf_dir):
    """Assignor rows through the role join with heavy keys salted (16 shares); equals the plain join."""
    t = _world(spark, sf_dir)
    rows = contracts.assignor_rows(t["detcedant"], t["detcedantcatal"], t["pcttypdrt"], t["partpt"],
                                   salt_buckets=16)
    return rows.select("idctr", "numpers", "catalog", "role", "pct_publisher", "pct_creator",
                       key_string("right_types").alias("right_types_key"))


@query
def jn_chain_position(spark, sf_dir):
    """Level-1 chains joined by position (pivot = element size-1 = head of the other)."""
    base = _base(spark, sf_dir)
    matched = chains.position_pairs(chains.overlap_level(base), 1)
    return matched.select(key_string("a.chain").alias("left_key"), key_string("b.chain").alias("right_key")).distinct()


@query
def jn_owner_chain_left(spark, sf_dir):
    """Owner rows left-joined to flattened chains (catalog, right type, territory)."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    rows = restitution.owner_chains(keys, flat)
    return rows.select("ide12", "let", "numcatal", "cle", key_string("chain").alias("chain_key"), "assignee_catalog",
                       "assignor_role", "pct_publisher")


@query
def jn_right_holders_sql(spark, sf_dir):
    """Right holders of all works by their cessions' territory elements."""
    t = _world(spark, sf_dir)
    req = restitution.single_request(t["oeuv"].select("ide12"), W.COUNTRY, W.RIGHT_TYPE, W.CONSULT_DATE)
    return restitution.right_holders(t, territories.leaf_sets(t["gpeter"]), req)


# ------------------------------------------------- pair combination (CH-4..7)
def _pairs_combined(spark, sf_dir) -> DataFrame:
    return chains.overlap_sides(_base(spark, sf_dir)).select(chains.combine("a", "b")).dropDuplicates()


@query
def chn_pair_combine(spark, sf_dir):
    """Every overlapping pair combined (before the void filter): dates, percents, sets, void flag."""
    return chain_text(_pairs_combined(spark, sf_dir), F.col("_void").alias("is_void"))


@query
def fn_array_index_slice(spark, sf_dir):
    """Head, last element, chain without its last element, and length of every chain."""
    base = _base(spark, sf_dir)
    ch = chains.build(base, W.MAX_DEPTH).select("chain").distinct()
    return ch.select(
        key_string("chain").alias("chain_key"),
        F.get(F.col("chain"), 0).alias("head"),
        F.element_at("chain", -1).alias("last"),
        key_string(F.slice("chain", 1, F.size("chain") - 1)).alias("without_last"),
        F.size("chain").alias("n"),
    )


@query
def fn_flatten(spark, sf_dir):
    """All right types of a contract's assignors, flattened (duplicates kept)."""
    from rightsweave.functions.arrays import flatten_or_empty
    t = _world(spark, sf_dir)
    a = contracts.assignors(t["detcedant"], t["detcedantcatal"], t["pcttypdrt"], t["partpt"])
    flat = flatten_or_empty(F.transform("assignors", lambda x: x["right_types"]), "string")
    return a.select("idctr", key_string(flat).alias("right_types_key"))


@query
def win_last_value(spark, sf_dir):
    """Last include/exclude state per (complex territory, leaf) by element order."""
    t = _world(spark, sf_dir)
    sets = territories.leaf_sets(t["gpeter"])
    return territories.last_states(t["eltter"], sets)


# ----------------------------------------------- pair-level function outputs
@query
def fn_combine_dates(spark, sf_dir):
    """Combined validity of every overlapping pair: later start, earlier end (null end stays open)."""
    p = _pairs_combined(spark, sf_dir)
    return p.select(key_string("chain").alias("chain_key"), "start_date", "end_date").distinct()


@query
def chn_pct(spark, sf_dir):
    """Publisher percents after a link: element-wise truncated product when the next assignor is E."""
    p = _pairs_combined(spark, sf_dir)
    pcts = F.array_join(F.transform("assignors", lambda x: _dec(x["pct_publisher"])), ";")
    return p.select(key_string("chain").alias("chain_key"), pcts.alias("pct_publisher_key")).distinct()


@query
def chn_restriction_meet(spark, sf_dir):
    """Inclusive restriction meets and exclusive unions of every pair, with the void flag."""
    p = _pairs_combined(spark, sf_dir)
    return p.select(
        key_string("chain").alias("chain_key"),
        key_string("genre_incl").alias("genre_incl_key"), key_string("catalog_incl").alias("catalog_incl_key"),
        key_string("work_incl").alias("work_incl_key"), key_string("genre_excl").alias("genre_excl_key"),
        key_string("work_excl").alias("work_excl_key"), F.col("_void").alias("is_void"),
    ).distinct()


@query
def fn_array_sets(spark, sf_dir):
    """Territory intersection of every pair: members, size, contains country 3."""
    p = _pairs_combined(spark, sf_dir)
    return p.select(
        key_string("chain").alias("chain_key"), key_string("territories").alias("territories_key"),
        F.size("territories").alias("n_territories"),
        F.coalesce(F.array_contains("territories", W.COUNTRY), F.lit(False)).alias("has_country"),
    ).distinct()


@query
def agg_collect_union(spark, sf_dir):
    """Per contract, the distinct union of its partners' assignee catalogs (as rows)."""
    return pairs.partner_union(chains.overlap_sides(_base(spark, sf_dir)), "assignees.catalog", "catalog")


@query
def agg_collect_intersect(spark, sf_dir):
    """Per contract, its countries also held by at least one partner (as rows)."""
    return pairs.partner_intersection(chains.overlap_sides(_base(spark, sf_dir)), "territories", "country")


@query
def agg_first_percent(spark, sf_dir):
    """Per contract and partner role, the first percents of its pairs."""
    return pairs.first_percents(chains.overlap_sides(_base(spark, sf_dir)))


def scalar_text(df: DataFrame) -> DataFrame:
    """Comparable projection of scalar chains."""
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    return df.select(*(key_string(c).alias(f"{c}_key") if c in arrays else F.col(c) for c in df.columns))


def _scalar_base(spark, sf_dir) -> DataFrame:
    t = _world(spark, sf_dir)
    with tracked() as paths:
        base = contracts.contract_base_scalar(t, jobs.territory_tables(t)["territories_by_id_tercmplx"], W.CONSULT_DATE)
    discard_unread(base, paths)
    return base


@query
def asm_contract_base_scalar(spark, sf_dir):
    """Older level 0: a row per contract, assignor entry, right type and assignee entry."""
    return scalar_text(_scalar_base(spark, sf_dir))


@query
def chn_levels_scalar(spark, sf_dir):
    """Older scalar chains of every level, with the level number."""
    return scalar_text(chains.scalar_levels(_scalar_base(spark, sf_dir), W.MAX_DEPTH))


# --------------------------------------------------------- doubling rounds
@query
def chn_doubling(spark, sf_dir):
    """Three rounds of overlap doubling over all contracts (sorted chains, last assignor dropped)."""
    base = _base(spark, sf_dir)
    df = base.select("chain", F.col("assignors.catalog").alias("cedant"),
                     F.col("assignees.catalog").alias("cess"))
    out = chains.doubling_rounds(df, 3)
    return out.select(key_string("chain").alias("chain_key"), key_string("cedant").alias("cedant_key"),
                      key_string("cess").alias("cess_key"))


# ------------------------------------------------------ restitution stages
@query
def win_longest_chain(spark, sf_dir):
    """Owner rows kept by the longest-chain / highest-priority filter (per first contract)."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    m = restitution.match_chains(keys, flat)
    return m.select("ide12", "lettrage", "numcatal_cedant_origine",
                    key_string("chaine_contrats").alias("chaine_contrats")).distinct()


@query
def win_prorata(spark, sf_dir):
    """Share of each managing publisher / creator within its (work, letter) category, in percent."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    s = restitution.with_group_stats(restitution.match_chains(keys, flat))
    return s.select("ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine", "gestnr", "cle",
                    key_string("chaine_contrats").alias("chaine_contrats"),
                    F.round("_prorata", 4).alias("prorata"))


@query
def win_first_manager_pct(spark, sf_dir):
    """Per (work, letter): the managing publisher's percents and the number of managed rows."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    return restitution.manager_percents(restitution.match_chains(keys, flat))


@query
def rst_excluded_work(spark, sf_dir):
    """Rows after work exclusions (share back to the origin where a chain excludes the work)."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    d = restitution.result_lines(restitution.shares(restitution.match_chains(keys, flat))).where("not residual")
    return d.select("ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine",
                    "numcatal_ayant_droit_final", "role_ad_final",
                    key_string("chaine_contrats").alias("chaine_contrats"),
                    F.round("pct_final", 4).alias("pct_final"))


@query
def rst_residual(spark, sf_dir):
    """Residual lines only: what a chain did not take, left with the origin holder."""
    _, flat, keys = _restitution_inputs(spark, sf_dir)
    d = restitution.result_lines(restitution.shares(restitution.match_chains(keys, flat))).where("residual")
    return d.select("ide12", "lettrage", "numcatal_cedant_origine", "role_ad_origine",
                    F.round("pct_final", 4).alias("cle")).distinct()


@query
def snk_dated_chain_roundtrip(spark, sf_dir):
    """Flattened chains written to a dated folder partitioned by right type and read back, every partition."""
    from rightsweave.sources import io
    base = _base(spark, sf_dir)
    flat = chains.flatten(chains.build(base, W.MAX_DEPTH))
    path = io.dated_path(_scratch(spark, "out"), "chains", W.MAX_DEPTH, W.CONSULT_DATE)
    io.write_parquet(flat, path, partition_by="right_type")
    back = spark.read.parquet(path)
    return back.select(key_string("chain").alias("chain_key"), "assignor_catalog", "assignor_role",
                       "pct_publisher", "assignee_catalog", "assignee_role", "right_type")


@query
def chn_level1_legacy(spark, sf_dir):
    """Level 1 with the older rules: inclusive genre/work united, untruncated percent, no void filter."""
    base = _base(spark, sf_dir)
    return chain_text(chains.overlap_level(base, legacy=True))


@query
def rst_restitution_context(spark, sf_dir):
    """Restitution of every work for context number 3 looked up in the context table."""
    t = _world(spark, sf_dir)
    with tracked() as paths:
        terr = jobs.territory_tables(t)
        flat = jobs.flat_chain_table(t, terr, W.CONSULT_DATE, W.MAX_DEPTH)
        req = restitution.context_requests(t["oeuv"], t["contexts"], 3)
        keys = restitution.static_keys(t, terr["territories_by_id_tercmplx"], req, keep_territories=False)
    return restitution.as_text(restitution.restitution(flat, keys, release=paths))
