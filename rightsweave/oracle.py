"""Independent SQL formulations (DuckDB dialect) of the library's jobs.

These strings are the correctness gate: the same demo world is defined as
CTEs over the benchmark tables (see :mod:`rightsweave.sources.world`) and
every job is re-stated in plain SQL – recursive CTE for closures, window
functions for group statistics, unnest joins for array overlap – without
sharing code with the Spark side.  Arrays are compared as ``a|b|c`` text.
"""

from __future__ import annotations

from rightsweave.sources import world as W

D = f"DATE '{W.CONSULT_DATE}'"
CREATORS = "('A', 'C', 'CA')"
RESTR = ("genre_incl", "genre_excl", "catalog_incl", "catalog_excl", "work_incl", "work_excl")


def round4(x: str) -> str:
    """Spark's ``round(double, 4)``: HALF_UP on the shortest decimal text of the value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 4) AS DOUBLE)"


def ctes(*parts: str, tables: tuple[str, ...] | None = None) -> str:
    """``WITH RECURSIVE`` world tables followed by the given CTE bodies."""
    head = W.world_ctes(tables, "duckdb").replace("WITH ", "WITH RECURSIVE ", 1).rstrip()
    body = ",\n".join(p.strip().rstrip(",") for p in parts if p.strip())
    return head + (",\n" + body if body else "") + "\n"


# ----------------------------------------------------------------- territories
TERR = """
t_edges AS (SELECT DISTINCT cdepaysiso4npere AS anc, cdepaysiso4nfils AS des FROM gpeter
            WHERE cdepaysiso4npere IS NOT NULL AND cdepaysiso4nfils IS NOT NULL),
t_clo(anc, des) AS (SELECT anc, des FROM t_edges
                    UNION SELECT c.anc, e.des FROM t_clo c JOIN t_edges e ON c.des = e.anc),
t_leaves AS (SELECT DISTINCT des AS leaf FROM t_edges WHERE des NOT IN (SELECT anc FROM t_edges)),
t_sets AS (SELECT c.anc AS cdepaysiso4n, list_sort(list(DISTINCT l.leaf)) AS fils
           FROM t_clo c JOIN t_leaves l ON c.des = l.leaf GROUP BY c.anc
           UNION ALL SELECT leaf, [leaf] FROM t_leaves),
t_el AS (SELECT e.idtercmplx, e.ord_list, e.incl, unnest(s.fils) AS leaf
         FROM eltter e JOIN t_sets s ON e.cdepaysiso4n = s.cdepaysiso4n),
t_last AS (SELECT idtercmplx, leaf, coalesce(incl <> 0, false) AS keep, incl AS last_incl FROM (
             SELECT *, row_number() OVER (PARTITION BY idtercmplx, leaf
                                          ORDER BY ord_list DESC, incl DESC) AS rn FROM t_el) WHERE rn = 1),
t_fold AS (SELECT idtercmplx, coalesce(list_sort(list(leaf) FILTER (WHERE keep)), []) AS territoires
           FROM t_last GROUP BY idtercmplx)
"""

# ------------------------------------------------------------------- contracts
VALID = f"""
vc AS (SELECT idctr, cdetypctr, numctr, indcsbl, datdbtctr,
              CASE WHEN datfinctr IS NULL THEN NULL
                   WHEN expireffetimmediat = 0 THEN coalesce(datfincollect, datfinctr)
                   ELSE datfinctr END AS datfinctr,
              idtercmplx, fledit, biem, idtercess, optaffl
       FROM contrat
       WHERE idctr IS NOT NULL
         AND (datfinctr IS NULL OR datdbtctr < datfinctr)
         AND (datfinsys IS NULL OR datdbtsys < datfinsys)
         AND (datfinsys IS NULL OR {D} < datfinsys)
         AND datdbtsys < {D}
         AND second = 0 AND cdestatutctr <> '000' AND cdestatutctr <> '003')
"""

ASSIGNORS = """
a_detail AS (SELECT d.idpcttypdrt, d.idctr, d.idpcttypdrtcre, d.numpers, c.numcatal
             FROM detcedant d JOIN detcedantcatal c ON d.iddetcedant = c.iddetcedant),
a_pub AS (SELECT x.idctr, x.idpcttypdrtcre, x.numpers, x.numcatal, coalesce(p.pct, 0.0) AS pct_publisher,
                 p.cdetypdrtsacem
          FROM a_detail x JOIN pcttypdrt p ON x.idpcttypdrt = p.idpcttypdrt),
a_cre AS (SELECT x.idctr, x.numpers, x.numcatal, x.pct_publisher, coalesce(q.pct, 0.0) AS pct_creator,
                 list(x.cdetypdrtsacem ORDER BY x.cdetypdrtsacem) AS right_types
          FROM a_pub x LEFT JOIN pcttypdrt q
            ON x.idpcttypdrtcre = q.idpcttypdrt AND x.cdetypdrtsacem = q.cdetypdrtsacem
          GROUP BY x.idctr, x.numpers, x.numcatal, x.pct_publisher, coalesce(q.pct, 0.0)),
a_roles AS (SELECT DISTINCT cdecategadsacem, numcatal, numpers FROM partpt),
a_rows AS (SELECT DISTINCT c.idctr, c.numpers, c.numcatal AS catalog, r.cdecategadsacem AS role,
                  c.pct_publisher, c.pct_creator, c.right_types
           FROM a_cre c JOIN a_roles r ON c.numcatal = r.numcatal AND c.numpers = r.numpers),
ors AS (SELECT idctr,
               list({'catalog': catalog, 'role': role, 'pct_publisher': pct_publisher,
                     'pct_creator': pct_creator, 'right_types': right_types}
                    ORDER BY catalog, role, pct_publisher, pct_creator, right_types) AS assignors
        FROM a_rows GROUP BY idctr)
"""

ASSIGNEES = """
ees AS (SELECT idctr,
               list({'catalog': numcatal, 'role': cdecategadsacem, 'manager': gestnr}
                    ORDER BY numcatal, cdecategadsacem, gestnr) AS assignees
        FROM (SELECT DISTINCT idctr, numcatal, cdecategadsacem, numpers, gestnr FROM detcess)
        GROUP BY idctr)
"""


def _restr_set(value: str, cond: str, alias: str) -> str:
    return (f"coalesce(list_sort(list(DISTINCT {value}) FILTER (WHERE {cond} AND {value} IS NOT NULL)), [])"
            f" AS {alias}")


RESTRICTIONS = f"""
r_parts AS (SELECT DISTINCT r.idctr, r.additif, p.numcatal, p.cdeexignc, g.cdegreoeuv, o.ide12
            FROM restrctr r
            LEFT JOIN restrpers p ON r.idrestctr = p.idrestctr
            LEFT JOIN restrgenre g ON r.idrestctr = g.idrestctr
            LEFT JOIN restroeuv o ON r.idrestctr = o.idrestctr),
res AS (SELECT idctr,
          {_restr_set('cdegreoeuv', 'additif = 1', 'genre_incl')},
          {_restr_set('cdegreoeuv', 'additif = 0', 'genre_excl')},
          {_restr_set('numcatal', "additif = 1 AND cdeexignc = 'STRICTE'", 'catalog_incl')},
          {_restr_set('numcatal', "additif = 0 AND cdeexignc = 'STRICTE'", 'catalog_excl')},
          {_restr_set('ide12', 'additif = 1', 'work_incl')},
          {_restr_set('ide12', 'additif = 0', 'work_excl')}
        FROM r_parts GROUP BY idctr)
"""

CHAIN_COLS = ("chain, assignors, assignees, contract_type, start_date, end_date, assignable, biem, "
              "idtercess, fledit, genre_incl, genre_excl, catalog_incl, catalog_excl, work_incl, "
              "work_excl, territories")

BASE = f"""
base AS (SELECT DISTINCT [c.numctr] AS chain, o.assignors, e.assignees, c.cdetypctr AS contract_type,
                c.datdbtctr AS start_date, c.datfinctr AS end_date, c.indcsbl AS assignable,
                c.biem, c.idtercess, c.fledit,
                coalesce(r.genre_incl, []) AS genre_incl, coalesce(r.genre_excl, []) AS genre_excl,
                coalesce(r.catalog_incl, []) AS catalog_incl, coalesce(r.catalog_excl, []) AS catalog_excl,
                CASE WHEN c.cdetypctr <> 'OPTION' AND c.optaffl = 0 AND o.assignors[1].role <> 'SE'
                     THEN coalesce(r.work_incl, []) ELSE [] END AS work_incl,
                CASE WHEN c.cdetypctr <> 'OPTION' AND c.optaffl = 0 AND o.assignors[1].role <> 'SE'
                     THEN coalesce(r.work_excl, []) ELSE [] END AS work_excl,
                list_sort(list_distinct(t.territoires)) AS territories
         FROM vc c JOIN ors o ON c.idctr = o.idctr JOIN ees e ON c.idctr = e.idctr
         LEFT JOIN res r ON c.idctr = r.idctr JOIN t_fold t ON c.idtercmplx = t.idtercmplx),
lvl0 AS (SELECT {CHAIN_COLS} FROM base)
"""


def _void(a: str, b: str) -> str:
    return (f"(NOT (len({a}) = 0 AND len({b}) = 0) AND "
            f"(len({a}) = 0 OR len({b}) = 0 OR len(list_intersect({a}, {b})) = 0))")


def combine_sql(a: str = "a", b: str = "b", legacy: bool = False) -> str:
    """Select list combining chain ``a`` followed by chain ``b``."""
    def inter(c):
        return f"list_sort(list_intersect({a}.{c}, {b}.{c})) AS {c}"

    def union(c):
        return f"list_sort(list_distinct(list_concat({a}.{c}, {b}.{c}))) AS {c}"

    prod = f"x.pct_publisher * {b}.assignors[i].pct_publisher / 100.0"
    if not legacy:
        prod = f"CAST(CAST(trunc({prod}) AS BIGINT) AS DOUBLE)"
    pct = (f"CASE WHEN {b}.assignors[1].role = 'E' THEN list_transform({a}.assignors, lambda x, i: "
           f"{{'catalog': x.catalog, 'role': x.role, "
           f"'pct_publisher': {prod}, 'pct_creator': x.pct_creator, 'right_types': x.right_types}}) "
           f"ELSE {a}.assignors END AS assignors")
    if legacy:
        return ",\n".join([
            f"list_concat({a}.chain, list_filter({b}.chain, lambda x: NOT list_contains({a}.chain, x))) AS chain",
            pct, f"{b}.assignees AS assignees", f"{a}.contract_type AS contract_type",
            f"CASE WHEN {a}.start_date < {b}.start_date THEN {b}.start_date ELSE {a}.start_date END AS start_date",
            f"CASE WHEN {a}.end_date > {b}.end_date THEN {b}.end_date ELSE {a}.end_date END AS end_date",
            f"{b}.assignable AS assignable", f"{a}.biem AS biem", f"{a}.idtercess AS idtercess",
            f"{a}.fledit AS fledit",
            union("genre_incl"), union("genre_excl"), inter("catalog_incl"), union("catalog_excl"),
            union("work_incl"), union("work_excl"), inter("territories"), "false AS is_void",
        ])
    return ",\n".join([
        f"list_concat({a}.chain, list_filter({b}.chain, lambda x: NOT list_contains({a}.chain, x))) AS chain",
        pct,
        f"{b}.assignees AS assignees",
        f"{a}.contract_type AS contract_type",
        f"CASE WHEN {a}.start_date < {b}.start_date THEN {b}.start_date ELSE {a}.start_date END AS start_date",
        f"CASE WHEN {a}.end_date > {b}.end_date THEN {b}.end_date ELSE {a}.end_date END AS end_date",
        f"{b}.assignable AS assignable",
        f"{a}.biem AS biem", f"{a}.idtercess AS idtercess", f"{a}.fledit AS fledit",
        inter("genre_incl"), union("genre_excl"),
        inter("catalog_incl"), union("catalog_excl"),
        inter("work_incl"), union("work_excl"),
        inter("territories"),
        f"({_void(a + '.genre_incl', b + '.genre_incl')} OR {_void(a + '.catalog_incl', b + '.catalog_incl')}"
        f" OR {_void(a + '.work_incl', b + '.work_incl')}) AS is_void",
    ])


def _kept(inner: str) -> str:
    return f"SELECT DISTINCT {CHAIN_COLS} FROM ({inner}) WHERE NOT is_void AND len(territories) > 0"


def overlap_level_sql(src: str, name: str) -> str:
    inner = (
        f"SELECT {combine_sql()} FROM "
        f"(SELECT *, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM {src} "
        f" WHERE assignable = 1) a "
        f"JOIN (SELECT *, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM {src}) b "
        f"ON a.k = b.k"
    )
    return f"{name} AS ({_kept(inner)})"


def position_level_sql(src: str, depth: int, name: str) -> str:
    inner = (
        f"SELECT {combine_sql()} FROM {src} a JOIN {src} b "
        f"ON (CASE WHEN len(a.chain) - {depth} >= 0 THEN a.chain[len(a.chain) - {depth} + 1] END) = b.chain[1] "
        f"WHERE a.assignable = 1"
    )
    return f"{name} AS ({_kept(inner)})"


def levels_sql(max_depth: int) -> str:
    parts = [overlap_level_sql("lvl0", "lvl1")]
    for depth in range(1, max_depth):
        parts.append(position_level_sql(f"lvl{depth}", depth, f"lvl{depth + 1}"))
    union = " UNION ALL ".join(f"SELECT {CHAIN_COLS} FROM lvl{i}" for i in range(max_depth + 1))
    parts.append(f"chains AS (SELECT DISTINCT {CHAIN_COLS} FROM ({union}))")
    return ",\n".join(parts)


def paths_sql(max_depth: int) -> str:
    """Clean mode: extend by one base contract, no repeats."""
    parts = []
    for depth in range(max_depth):
        src = "lvl0" if depth == 0 else f"pth{depth}"
        inner = (
            f"SELECT {combine_sql()} FROM "
            f"(SELECT *, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM {src} "
            f" WHERE assignable = 1) a "
            f"JOIN (SELECT *, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b "
            f"ON a.k = b.k WHERE NOT list_contains(a.chain, b.chain[1])"
        )
        parts.append(f"pth{depth + 1} AS ({_kept(inner)})")
    union = " UNION ALL ".join([f"SELECT {CHAIN_COLS} FROM lvl0"] +
                               [f"SELECT {CHAIN_COLS} FROM pth{i}" for i in range(1, max_depth + 1)])
    parts.append(f"paths AS (SELECT DISTINCT {CHAIN_COLS} FROM ({union}))")
    return ",\n".join(parts)


def _txt(expr: str) -> str:
    return f"array_to_string({expr}, '|')"


def _dec(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,4)) AS VARCHAR)"


def chain_text_sql(src: str, extra: str = "") -> str:
    """Text projection of a chain table (matches ``registry.chain_text``)."""
    ors = ("array_to_string(list_transform(assignors, lambda x: concat_ws(':', CAST(x.catalog AS VARCHAR), "
           f"x.role, {_dec('x.pct_publisher')}, {_dec('x.pct_creator')}, "
           "array_to_string(x.right_types, '+'))), ';')")
    ees = ("array_to_string(list_transform(assignees, lambda x: concat_ws(':', CAST(x.catalog AS VARCHAR), "
           "x.role, CAST(x.manager AS VARCHAR))), ';')")
    return (
        f"SELECT {_txt('chain')} AS chain_key, {ors} AS assignors_key, {ees} AS assignees_key, "
        "contract_type, start_date, end_date, assignable, biem, idtercess, fledit, "
        f"{_txt('genre_incl')} AS genre_incl_key, {_txt('genre_excl')} AS genre_excl_key, "
        f"{_txt('catalog_incl')} AS catalog_incl_key, {_txt('catalog_excl')} AS catalog_excl_key, "
        f"{_txt('work_incl')} AS work_incl_key, {_txt('work_excl')} AS work_excl_key, "
        f"{_txt('territories')} AS territories_key{', ' + extra if extra else ''} FROM {src}"
    )


def flat_sql(src: str, name: str = "flat") -> str:
    return (
        f"{name} AS (SELECT f.chain, o.catalog AS assignor_catalog, o.role AS assignor_role, "
        "o.pct_publisher AS pct_publisher, o.pct_creator AS pct_creator, rt AS right_type, "
        "e.catalog AS assignee_catalog, e.role AS assignee_role, e.manager AS assignee_manager, "
        "f.contract_type, f.start_date, f.end_date, f.assignable, f.territories, "
        f"{', '.join('f.' + c for c in RESTR)} "
        f"FROM {src} f, unnest(f.assignors) AS u(o), unnest(o.right_types) AS v(rt), "
        "unnest(f.assignees) AS w(e))"
    )


CONTRACT_PARTS = (TERR, VALID, ASSIGNORS, ASSIGNEES, RESTRICTIONS, BASE)

# ----------------------------------------------------------------- restitution


def static_keys_sql(batch: bool = False) -> str:
    """Owner rows; ``batch`` takes the context of every request row."""
    if batch:
        req = ("(SELECT r.ide12, x.num_contexte, x.code_iso4n_pays, x.code_type_droit, x.date_consultation "
               "FROM requests r JOIN contexts x ON r.num_contexte = x.num_contexte)")
    else:
        req = (f"(SELECT DISTINCT ide12, 0 AS num_contexte, {W.COUNTRY} AS code_iso4n_pays, "
               f"'{W.RIGHT_TYPE}' AS code_type_droit, {D} AS date_consultation FROM oeuv)")
    return f"""
sk AS (SELECT DISTINCT q.num_contexte, q.code_iso4n_pays AS ctry,
              o.idoeuv, o.ide12, j.cdetypdrtsacem, p.numpers, p.numcatal, a.cle, p.cdecategadsacem,
              p.let, a.cde_motif_mise_en_attente, c.idtercmplx, t.territoires, a.cedant, a.gestnr, c.priort
       FROM {req} q
       JOIN oeuv o ON o.ide12 = q.ide12 AND o.datdbtsys < q.date_consultation
                  AND (o.datfinsys > q.date_consultation OR o.datfinsys IS NULL)
       JOIN (SELECT DISTINCT idcess, idoeuv, idtercmplx, priort FROM cess) c ON o.idoeuv = c.idoeuv
       JOIN t_fold t ON c.idtercmplx = t.idtercmplx
                    AND coalesce(list_contains(t.territoires, q.code_iso4n_pays), false)
       JOIN (SELECT DISTINCT idjeucle, cdetypdrtsacem, idcess FROM jeucle) j
         ON j.idcess = c.idcess AND j.cdetypdrtsacem = q.code_type_droit
       JOIN (SELECT DISTINCT idayantdrt, idjeucle, idpartpt, cle, cedant, gestnr, cde_motif_mise_en_attente
             FROM ayant_droit) a ON a.idjeucle = j.idjeucle
       JOIN (SELECT DISTINCT idoeuv, idpartpt, numpers, numcatal, cdecategadsacem, let FROM partpt) p
         ON p.idoeuv = o.idoeuv AND p.idpartpt = a.idpartpt)
"""


def match_sql(strict: bool = False) -> str:
    part = "num_contexte, ch[1]" + (", ide12, lettrage, orig" if strict else "")
    return f"""
m AS (SELECT k.num_contexte, k.ide12, k.let AS lettrage, k.numcatal AS orig,
             coalesce(f.assignor_role, k.cdecategadsacem) AS role_o,
             coalesce(f.assignee_catalog, k.numcatal) AS cat_f,
             coalesce(f.assignee_role, k.cdecategadsacem) AS role_f,
             f.chain AS ch, f.pct_publisher AS pe, f.pct_creator AS pc, k.cle, k.priort, k.gestnr,
             {', '.join('f.' + c for c in RESTR)}
      FROM sk k LEFT JOIN flat f
        ON k.numcatal = f.assignor_catalog AND f.right_type = k.cdetypdrtsacem
       AND coalesce(list_contains(f.territories, k.ctry), false)),
w1 AS (SELECT DISTINCT num_contexte, ide12, lettrage, orig, role_o, cat_f, role_f, ch, pe, pc, cle, gestnr,
                       {', '.join(RESTR)}
       FROM (SELECT *, coalesce(len(ch), -1) AS ln,
                    max(coalesce(len(ch), -1)) OVER (PARTITION BY {part}) AS mx,
                    max(priort) OVER (PARTITION BY {part}) AS mp FROM m)
       WHERE ln = mx AND priort = mp)
"""


SHARES = f"""
s1 AS (SELECT *,
         CAST(sum(CAST(CASE WHEN role_o = 'E' AND gestnr = 1 THEN cle ELSE 0 END AS DECIMAL(38,12))) OVER g AS DOUBLE) AS s_mgr,
         CAST(sum(CAST(CASE WHEN role_o IN {CREATORS} THEN cle ELSE 0 END AS DECIMAL(38,12))) OVER g AS DOUBLE) AS s_crea,
         max(CASE WHEN role_o = 'E' AND gestnr = 1 THEN pe END) OVER g AS m_pe,
         max(CASE WHEN role_o = 'E' AND gestnr = 1 THEN pc END) OVER g AS m_pc,
         sum(CASE WHEN gestnr <> 0 THEN 1 ELSE 0 END) OVER g AS n_man
       FROM w1 WINDOW g AS (PARTITION BY num_contexte, ide12, lettrage)),
s2 AS (SELECT *, CASE WHEN role_o = 'E' AND gestnr = 1 THEN cle / nullif(s_mgr, 0) * 100
                      WHEN role_o IN {CREATORS} THEN cle / nullif(s_crea, 0) * 100 END AS prorata FROM s1),
s3 AS (SELECT *, coalesce(CASE WHEN role_o = 'E' AND gestnr = 0 THEN m_pe
                               WHEN role_o IN {CREATORS} THEN m_pc * prorata / 100
                               ELSE pe END, 0.0) AS part FROM s2),
s4 AS (SELECT *, CASE WHEN n_man > 0 THEN cle * part / 100
                      ELSE CASE WHEN role_o IN {CREATORS} THEN cle * pc / 100 ELSE cle * pe / 100 END
                 END AS cede FROM s3),
s5 AS (SELECT *, cle - coalesce(cede, 0) AS rest,
              CAST(sum(CAST(CASE WHEN gestnr = 0 THEN cede END AS DECIMAL(38,12))) OVER (PARTITION BY num_contexte, ide12, lettrage) AS DOUBLE) AS s_unm
       FROM s4),
s6 AS (SELECT *, CASE WHEN ch IS NOT NULL AND gestnr = 0 THEN cede
                      WHEN ch IS NOT NULL AND gestnr = 1 THEN s_unm + cede
                      ELSE rest END AS fin FROM s5),
s7 AS (SELECT num_contexte, ide12, lettrage, orig, role_o, pe, cle, rest,
              CASE WHEN ex THEN cle ELSE fin END AS fin,
              CASE WHEN ex THEN orig ELSE cat_f END AS cat_f,
              CASE WHEN ex THEN role_o ELSE role_f END AS role_f,
              CASE WHEN ex THEN NULL ELSE ch END AS ch
       FROM (SELECT *, coalesce(list_contains(work_excl, ide12), false) AS ex FROM s6)),
s8 AS (SELECT *, CAST(sum(CAST(cle AS DECIMAL(38,12))) OVER (PARTITION BY num_contexte, ide12, lettrage, orig) AS DOUBLE) AS gsum FROM s7),
restit AS (SELECT DISTINCT num_contexte, ide12, lettrage, orig AS numcatal_cedant_origine,
                  role_o AS role_ad_origine, cat_f AS numcatal_ayant_droit_final, role_f AS role_ad_final,
                  array_to_string(ch, '|') AS chaine_contrats, {round4('fin')} AS cle
           FROM (SELECT num_contexte, ide12, lettrage, orig, role_o, cat_f, role_f, ch, fin FROM s8
                 UNION ALL
                 SELECT num_contexte, ide12, lettrage, orig, role_o, orig, role_o, NULL, rest FROM s8
                 WHERE ch IS NOT NULL AND pe <> 100 AND gsum <> 100))
"""

RESULT = ("ide12, lettrage, numcatal_cedant_origine, role_ad_origine, numcatal_ayant_droit_final, "
          "role_ad_final, chaine_contrats, cle")


# --------------------------------------------------------------- query texts
def _chain_tables() -> str:
    return ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH))


def _restit(strict: bool = False, batch: bool = False) -> str:
    return ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains"), static_keys_sql(batch),
                match_sql(strict=strict), SHARES)


def _levels_union() -> str:
    return " UNION ALL ".join(
        f"SELECT *, {i} AS level FROM ({chain_text_sql(f'lvl{i}')})" for i in range(W.MAX_DEPTH + 1))


REACH = """
edge AS (SELECT DISTINCT a.chain[1] AS from_ctr, b.chain[1] AS to_ctr
         FROM (SELECT chain, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM lvl0
               WHERE assignable = 1) a
         JOIN (SELECT chain, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b
           ON a.k = b.k),
walk(from_ctr, to_ctr, hops) AS (SELECT from_ctr, to_ctr, 1 FROM edge
         UNION SELECT w.from_ctr, e.to_ctr, w.hops + 1 FROM walk w JOIN edge e ON w.to_ctr = e.from_ctr),
ends AS (SELECT DISTINCT chain[1] AS ctr, array_to_string(list_transform(assignors, lambda x: x.catalog), '|') AS ors,
                array_to_string(list_transform(assignees, lambda x: x.catalog), '|') AS ees FROM lvl0)
"""

SCALAR_KEYS = ("chain", "informants", *RESTR, "requirements", "territories")
SCALAR = f"""
s_entries AS (SELECT idctr, numpers AS op, catalog AS oc, role AS orole, pct_publisher AS pe, pct_creator AS pc,
                     unnest(right_types) AS rt FROM a_rows),
s_ees AS (SELECT DISTINCT idctr, numpers AS ep, numcatal AS ec, cdecategadsacem AS erole FROM detcess),
s_res AS (SELECT idctr,
            {_restr_set('cdegreoeuv', 'additif = 1', 'genre_incl')}, {_restr_set('cdegreoeuv', 'additif = 0', 'genre_excl')},
            {_restr_set('numcatal', 'additif = 1', 'catalog_incl')}, {_restr_set('numcatal', 'additif = 0', 'catalog_excl')},
            {_restr_set('ide12', 'additif = 1', 'work_incl')}, {_restr_set('ide12', 'additif = 0', 'work_excl')},
            {_restr_set('cdeexignc', 'true', 'requirements')}
          FROM r_parts GROUP BY idctr),
sc0 AS (SELECT DISTINCT [c.numctr] AS chain, [k.numinf] AS informants, c.cdetypctr AS contract_type,
               c.indcsbl AS assignable, c.biem, c.idtercess, c.fledit, c.datdbtctr AS start_date, c.datfinctr AS end_date,
               o.op AS assignor_person, o.oc AS assignor_catalog, o.orole AS assignor_role, o.rt AS right_type,
               o.pe AS pct_publisher, o.pc AS pct_creator,
               e.ep AS assignee_person, e.ec AS assignee_catalog, e.erole AS assignee_role,
               coalesce(r.genre_incl, []) AS genre_incl, coalesce(r.genre_excl, []) AS genre_excl,
               coalesce(r.catalog_incl, []) AS catalog_incl, coalesce(r.catalog_excl, []) AS catalog_excl,
               CASE WHEN c.cdetypctr <> 'OPTION' AND c.optaffl = 0 AND o.orole <> 'SE' THEN coalesce(r.work_incl, []) ELSE [] END
                   AS work_incl,
               CASE WHEN c.cdetypctr <> 'OPTION' AND c.optaffl = 0 AND o.orole <> 'SE' THEN coalesce(r.work_excl, []) ELSE [] END
                   AS work_excl,
               coalesce(r.requirements, []) AS requirements, list_sort(list_distinct(t.territoires)) AS territories
        FROM vc c JOIN contrat k ON c.idctr = k.idctr JOIN s_entries o ON c.idctr = o.idctr JOIN s_ees e ON c.idctr = e.idctr
        LEFT JOIN s_res r ON c.idctr = r.idctr JOIN t_fold t ON c.idtercmplx = t.idtercmplx)
"""


def scalar_levels_sql(max_depth: int) -> str:
    """The older scalar chains, level by level, with their union ``sc``."""
    def new_of(c: str) -> str:
        return f"list_concat(a.{c}, list_filter(b.{c}, lambda x: NOT list_contains(a.{c}, x))) AS {c}"

    def both(c: str) -> str:
        return f"list_sort(list_distinct(list_concat(a.{c}, b.{c}))) AS {c}"

    parts = []
    for d in range(max_depth):
        on = "a.assignee_catalog = b.assignor_catalog" if d == 0 else "a.chain[len(a.chain)] = b.chain[1]"
        parts.append(f"""
sc{d + 1} AS (SELECT DISTINCT {new_of('chain')}, {new_of('informants')}, a.contract_type, b.assignable, a.biem, a.idtercess,
         a.fledit, CASE WHEN a.start_date < b.start_date THEN b.start_date ELSE a.start_date END AS start_date,
         CASE WHEN a.end_date > b.end_date THEN b.end_date ELSE a.end_date END AS end_date,
         a.assignor_person, a.assignor_catalog, a.assignor_role, a.right_type,
         CASE WHEN b.assignor_role = 'E' THEN a.pct_publisher * b.pct_publisher / 100.0 ELSE a.pct_publisher END AS pct_publisher,
         a.pct_creator, b.assignee_person, b.assignee_catalog, b.assignee_role, {both('genre_incl')}, {both('genre_excl')},
         list_sort(list_intersect(a.catalog_incl, b.catalog_incl)) AS catalog_incl, {both('catalog_excl')},
         {both('work_incl')}, {both('work_excl')}, {both('requirements')},
         list_sort(list_intersect(a.territories, b.territories)) AS territories
         FROM sc{d} a JOIN sc{d} b ON {on} WHERE a.assignable = 1)""")
    union = " UNION ALL ".join(f"SELECT *, {i} AS level FROM sc{i}" for i in range(max_depth + 1))
    return ",".join([*parts, f"\nsc AS ({union})"])


def scalar_text_sql(src: str) -> str:
    keys = ", ".join(f"array_to_string({c}, '|') AS {c}_key" for c in SCALAR_KEYS)
    return f"SELECT * EXCLUDE ({', '.join(SCALAR_KEYS)}), {keys} FROM {src}"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ter_closure"] = ctes(TERR) + "SELECT anc AS ancestor, des AS descendant FROM t_clo"
    q["ter_leaves"] = ctes(TERR) + "SELECT leaf FROM t_leaves"
    q["ter_leaf_sets"] = ctes(TERR) + (
        "SELECT cdepaysiso4n, array_to_string(fils, '|') AS leaves_key, CAST(len(fils) AS INTEGER) AS n_leaves "
        "FROM t_sets")
    q["ter_fold"] = ctes(TERR) + (
        "SELECT idtercmplx, array_to_string(territoires, '|') AS countries_key, "
        "CAST(len(territoires) AS INTEGER) AS n_countries FROM t_fold")
    q["ter_fold_window"] = ctes(TERR) + (
        "SELECT idtercmplx, array_to_string(coalesce(list_sort(list(leaf) FILTER (WHERE last_incl = 1)), []), '|')"
        " AS countries_key, CAST(count(*) FILTER (WHERE last_incl = 1) AS INTEGER) AS n_countries "
        "FROM t_last GROUP BY idtercmplx")
    q["flt_contract_validity"] = ctes(VALID) + (
        "SELECT idctr, numctr, cdetypctr, indcsbl, datdbtctr, datfinctr, idtercmplx FROM vc")
    q["asm_assignors"] = ctes(ASSIGNORS) + (
        "SELECT idctr, array_to_string(list_transform(assignors, lambda x: concat_ws(':', "
        f"CAST(x.catalog AS VARCHAR), x.role, {_dec('x.pct_publisher')}, {_dec('x.pct_creator')}, "
        "array_to_string(x.right_types, '+'))), ';') AS assignors_key, "
        "CAST(len(assignors) AS INTEGER) AS n_assignors FROM ors")
    q["asm_assignees"] = ctes(ASSIGNEES) + (
        "SELECT idctr, array_to_string(list_transform(assignees, lambda x: concat_ws(':', "
        "CAST(x.catalog AS VARCHAR), x.role, CAST(x.manager AS VARCHAR))), ';') AS assignees_key, "
        "CAST(len(assignees) AS INTEGER) AS n_assignees FROM ees")
    q["asm_restrictions"] = ctes(RESTRICTIONS) + (
        "SELECT idctr, " + ", ".join(
            f"array_to_string({c}, '|') AS {c}_key"
            for c in ("genre_incl", "genre_excl", "catalog_incl", "catalog_excl", "work_incl", "work_excl"))
        + " FROM res")
    q["asm_contract_base"] = ctes(*CONTRACT_PARTS) + chain_text_sql("lvl0")
    q["jn_array_overlap"] = ctes(*CONTRACT_PARTS) + (
        "SELECT DISTINCT a.chain[1] AS from_ctr, b.chain[1] AS to_ctr FROM "
        "(SELECT chain, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM lvl0 "
        " WHERE assignable = 1) a "
        "JOIN (SELECT chain, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b "
        "ON a.k = b.k")
    q["jn_surviving_pairs"] = _chain_tables() + (
        "SELECT DISTINCT chain[1] AS from_ctr, chain[len(chain)] AS to_ctr FROM lvl1")
    q["chn_level1"] = _chain_tables() + chain_text_sql("lvl1")
    q["chn_levels"] = _chain_tables() + _levels_union()
    q["chn_build"] = _chain_tables() + chain_text_sql("chains")
    q["chn_paths"] = ctes(*CONTRACT_PARTS, paths_sql(W.MAX_DEPTH)) + chain_text_sql("paths")
    q["chn_flatten"] = ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains")) + (
        "SELECT array_to_string(chain, '|') AS chain_key, assignor_catalog, assignor_role, pct_publisher, "
        "pct_creator, right_type, assignee_catalog, assignee_role, assignee_manager, contract_type, "
        "start_date, end_date, assignable, array_to_string(territories, '|') AS territories_key, "
        "array_to_string(work_excl, '|') AS work_excl_key FROM flat")
    q["chn_overlap_closure"] = ctes(*CONTRACT_PARTS, REACH) + (
        "SELECT w.from_ctr, w.to_ctr, w.hops, f.ors AS assignor_catalogs_key, t.ees AS assignee_catalogs_key "
        "FROM (SELECT from_ctr, to_ctr, CAST(min(hops) AS INTEGER) AS hops FROM walk GROUP BY from_ctr, to_ctr) w "
        "JOIN (SELECT DISTINCT ctr, ors FROM ends) f ON f.ctr = w.from_ctr "
        "JOIN (SELECT DISTINCT ctr, ees FROM ends) t ON t.ctr = w.to_ctr")
    q["asm_contract_base_scalar"] = ctes(*CONTRACT_PARTS, SCALAR) + scalar_text_sql("sc0")
    q["chn_levels_scalar"] = ctes(*CONTRACT_PARTS, SCALAR, scalar_levels_sql(W.MAX_DEPTH)) + scalar_text_sql("sc")
    q["rst_static_keys"] = ctes(TERR, static_keys_sql()) + (
        "SELECT idoeuv, ide12, cdetypdrtsacem, numpers, numcatal, cle, cdecategadsacem, let, "
        "cde_motif_mise_en_attente, idtercmplx, array_to_string(territoires, '|') AS territoires_key, "
        "cedant, gestnr, priort FROM sk")
    rest = ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains"), static_keys_sql(), match_sql())
    q["rst_match"] = rest + (
        "SELECT ide12, lettrage, orig AS numcatal_cedant_origine, role_o AS role_ad_origine, "
        "cat_f AS numcatal_ayant_droit_final, role_f AS role_ad_final, "
        "array_to_string(ch, '|') AS chaine_contrats, pe AS pct_editeur, pc AS pct_createur, cle, gestnr, "
        + ", ".join(f"array_to_string({c}, '|') AS {c}_key" for c in RESTR) + " FROM w1")
    q["rst_shares"] = _restit() + (
        "SELECT ide12, lettrage, orig AS numcatal_cedant_origine, role_o AS role_ad_origine, "
        "cat_f AS numcatal_ayant_droit_final, role_f AS role_ad_final, "
        "array_to_string(ch, '|') AS chaine_contrats, cle, gestnr, "
        f"{round4('cede')} AS pct_cede, {round4('rest')} AS pct_restant, {round4('fin')} AS pct_final FROM s6")
    q["rst_restitution"] = _restit() + f"SELECT {RESULT} FROM restit"
    q["rst_restitution_strict"] = _restit(strict=True) + f"SELECT {RESULT} FROM restit"
    q["rst_restitution_batch"] = _restit(batch=True) + f"SELECT num_contexte, {RESULT} FROM restit"
    q["rst_restitution_dates"] = _dated()
    q["chn_incremental"] = q["chn_build"]
    _more(q)
    return q


def _dated() -> str:
    """One whole run at each context's own date."""
    runs = [_restit(batch=True).replace(D, f"DATE '{date}'") + f"SELECT num_contexte, {RESULT} FROM restit WHERE num_contexte = {number}"
            for number, date in W.CONTEXT_DATES.items()]
    return " UNION ALL ".join(f"SELECT * FROM ({run})" for run in runs)


def _pairs() -> str:
    return (
        f"pairs AS (SELECT DISTINCT * FROM (SELECT {combine_sql()} FROM "
        "(SELECT *, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM lvl0 WHERE assignable = 1) a "
        "JOIN (SELECT *, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b ON a.k = b.k))")


def _pair_sides() -> str:
    return ("sides AS (SELECT DISTINCT a.chain AS a_chain, a.territories AS a_terr, b.assignees AS b_ees, "
            "b.territories AS b_terr, a.assignors AS a_ors, b.assignors AS b_ors FROM "
            "(SELECT *, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM lvl0 WHERE assignable = 1) a "
            "JOIN (SELECT *, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b ON a.k = b.k)")


def _doubling(rounds: int) -> str:
    parts = ["d0 AS (SELECT chain, list_transform(assignors, lambda x: x.catalog) AS cedant, "
             "list_transform(assignees, lambda x: x.catalog) AS cess FROM lvl0)"]
    for r in range(1, rounds + 1):
        p = f"d{r - 1}"
        parts.append(
            f"m{r} AS (SELECT DISTINCT list_sort(list_distinct(list_concat(a.chain, b.chain))) AS chain, "
            "list_filter(list_concat(a.cedant, b.cedant), lambda x, i: "
            "list_position(list_concat(a.cedant, b.cedant), x) = i) AS cedant, "
            f"b.cess AS cess FROM (SELECT DISTINCT * FROM {p}) a0 "
            f"JOIN (SELECT chain, cedant, cess, unnest(cess) AS k FROM {p}) a ON a0.chain = a.chain "
            "AND a0.cedant = a.cedant AND a0.cess = a.cess "
            f"JOIN (SELECT chain, cedant, cess, unnest(cedant) AS k FROM {p}) b ON a.k = b.k)")
        parts.append(f"d{r} AS (SELECT DISTINCT chain, cedant[1:len(cedant) - 1] AS cedant, cess FROM m{r})")
    union = " UNION ALL ".join(f"SELECT * FROM d{r}" for r in range(rounds + 1))
    parts.append(f"dbl AS ({union})")
    return ",\n".join(parts)


def _more(q: dict[str, str]) -> None:
    q["src_projected_read"] = "SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem"
    q["src_parse_pipe_array"] = (
        "SELECT l_partkey AS ide12, CASE WHEN l_linenumber % 3 = 1 THEN 'A' WHEN l_linenumber % 3 = 2 THEN 'B' END"
        " AS lettrage, l_orderkey AS numcatal_cedant_origine, l_returnflag AS role_ad_origine, "
        "l_suppkey AS numcatal_ayant_droit_final, l_linestatus AS role_ad_final, "
        "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_orderkey + l_linenumber AS VARCHAR) AS chain_key, "
        "CAST(2 AS INTEGER) AS chain_len, l_quantity AS cle FROM lineitem")
    q["src_csv_rejects"] = """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN reasons IS NULL THEN CAST(o_custkey AS BIGINT) END AS o_custkey,
       CASE WHEN reasons IS NULL THEN CAST(o_orderdate AS DATE) END AS o_orderdate, reasons
FROM (SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN '2 fields instead of 3'
                     WHEN o_orderkey % 89 = 0 THEN '4 fields instead of 3'
                     WHEN o_orderkey % 83 = 0 THEN 'o_custkey is not bigint; o_orderdate is not date' END AS reasons
      FROM orders)"""
    q["snk_partitioned_roundtrip"] = ctes() + (
        "SELECT idpcttypdrt, idclauspartcl, pct, cdetypdrtsacem FROM pcttypdrt")
    q["snk_snapshots"] = """
SELECT o_orderkey, o_custkey, o_orderstatus AS status, CAST(1 AS INTEGER) AS version FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(2 AS INTEGER) FROM orders"""
    q["snk_csv_to_parquet"] = (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
        "c_mktsegment FROM customer")
    q["snk_compute_if_absent"] = q["ter_fold"]
    q["flt_contract_validity_lenient"] = ctes() + f"""
SELECT idctr, numctr, datdbtctr,
       CASE WHEN datfinctr IS NULL THEN NULL WHEN expireffetimmediat = 0 THEN coalesce(datfincollect, datfinctr)
            ELSE datfinctr END AS datfinctr,
       datdbtsys, datfinsys, second, cdestatutctr
FROM contrat
WHERE (datfinctr IS NULL OR datdbtctr < datfinctr) AND (datfinsys IS NULL OR datdbtsys < datfinsys)
  AND (datfinsys IS NULL OR {D} < datfinsys) AND datdbtsys < {D}
  AND second <> 1 AND cdestatutctr <> '000' AND cdestatutctr <> '003'"""
    q["prj_end_override"] = ctes() + (
        "SELECT idctr, datfinctr AS datfinctr_raw, CASE WHEN datfinctr IS NULL THEN NULL "
        "WHEN expireffetimmediat = 0 THEN coalesce(datfincollect, datfinctr) ELSE datfinctr END AS datfinctr "
        "FROM contrat")
    q["flt_active_works"] = ctes() + (
        f"SELECT DISTINCT idoeuv, ide12 FROM oeuv WHERE datdbtsys < {D} AND (datfinsys > {D} OR datfinsys IS NULL)")
    q["flt_territory_contains"] = ctes(TERR) + (
        f"SELECT idtercmplx FROM t_fold WHERE coalesce(list_contains(territoires, {W.COUNTRY}), false)")
    q["prj_suffix"] = ctes() + (
        "SELECT iddetcedant, idpcttypdrt AS idpcttypdrt_cedant, idctr, idpcttypdrtcre AS idpcttypdrtcre_cedant, "
        "numpers AS numpers_cedant FROM detcedant")
    q["prj_prefix"] = ctes() + "SELECT " + ", ".join(
        f"{c} AS detcess_{c}" for c in ("iddetcessnr", "cdecategadsacem", "numcatal", "numpers", "gestnr",
                                        "datdbtvld", "datfinvld", "idctr", "idpcttypdrt")) + " FROM detcess"
    gate = "(c.cdetypctr <> 'OPTION' AND c.optaffl = 0 AND o.assignors[1].role <> 'SE')"
    q["prj_restriction_gate"] = ctes(VALID, ASSIGNORS, RESTRICTIONS) + (
        f"SELECT c.idctr, {gate} AS applies, "
        f"array_to_string(CASE WHEN {gate} THEN coalesce(r.work_incl, []) ELSE [] END, '|') AS work_incl_key, "
        f"array_to_string(CASE WHEN {gate} THEN coalesce(r.work_excl, []) ELSE [] END, '|') AS work_excl_key "
        "FROM vc c JOIN ors o ON c.idctr = o.idctr LEFT JOIN res r ON c.idctr = r.idctr")
    q["agg_distinct_rows"] = ctes() + "SELECT DISTINCT cdecategadsacem, numcatal, numpers FROM partpt"
    q["jn_creator_pct_left"] = ctes(ASSIGNORS) + (
        "SELECT idctr, numpers, numcatal, pct_publisher, pct_creator, "
        "array_to_string(right_types, '|') AS right_types_key FROM a_cre")
    q["jn_salted_equals_plain"] = ctes(ASSIGNORS) + (
        "SELECT idctr, numpers, catalog, role, pct_publisher, pct_creator, "
        "array_to_string(right_types, '|') AS right_types_key FROM a_rows")
    q["jn_chain_position"] = _chain_tables() + (
        "SELECT DISTINCT array_to_string(a.chain, '|') AS left_key, array_to_string(b.chain, '|') AS right_key "
        "FROM lvl1 a JOIN lvl1 b ON a.chain[len(a.chain)] = b.chain[1] WHERE a.assignable = 1")
    q["jn_owner_chain_left"] = ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains"),
                                    static_keys_sql()) + (
        "SELECT k.ide12, k.let, k.numcatal, k.cle, array_to_string(f.chain, '|') AS chain_key, "
        "f.assignee_catalog, f.assignor_role, f.pct_publisher FROM sk k LEFT JOIN flat f "
        "ON k.numcatal = f.assignor_catalog AND f.right_type = k.cdetypdrtsacem "
        "AND coalesce(list_contains(f.territories, k.ctry), false)")
    q["jn_right_holders_sql"] = ctes(TERR) + (
        f"""SELECT idayantdrt, idjeucle, idpartpt, cle, gestnr FROM (
  SELECT a.*, unnest(range(n.times)) AS nth
  FROM ayant_droit a JOIN jeucle USING (idjeucle) JOIN cess USING (idcess) JOIN oeuv USING (idoeuv)
  JOIN (SELECT idtercmplx, count(*) AS times FROM eltter WHERE cdepaysiso4n IN (SELECT cdepaysiso4n FROM t_sets) GROUP BY 1) n
    USING (idtercmplx)
  WHERE cdetypdrtsacem = '{W.RIGHT_TYPE}' AND oeuv.datdbtsys < {D} AND coalesce(oeuv.datfinsys > {D}, true))""")
    pairs = (
        f"pairs AS (SELECT DISTINCT * FROM (SELECT {combine_sql()} FROM "
        "(SELECT *, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM lvl0 WHERE assignable = 1) a "
        "JOIN (SELECT *, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b ON a.k = b.k))")
    q["chn_pair_combine"] = ctes(*CONTRACT_PARTS, pairs) + chain_text_sql("pairs", "is_void")
    q["fn_array_index_slice"] = _chain_tables() + (
        "SELECT array_to_string(chain, '|') AS chain_key, chain[1] AS head, chain[len(chain)] AS last, "
        "array_to_string(chain[1:len(chain) - 1], '|') AS without_last, CAST(len(chain) AS INTEGER) AS n "
        "FROM (SELECT DISTINCT chain FROM chains)")
    q["fn_flatten"] = ctes(ASSIGNORS) + (
        "SELECT idctr, array_to_string(flatten(list_transform(assignors, lambda x: x.right_types)), '|') "
        "AS right_types_key FROM ors")
    pair_ctes = ctes(*CONTRACT_PARTS, _pairs())
    q["fn_combine_dates"] = pair_ctes + (
        "SELECT DISTINCT array_to_string(chain, '|') AS chain_key, start_date, end_date FROM pairs")
    q["chn_pct"] = pair_ctes + (
        "SELECT DISTINCT array_to_string(chain, '|') AS chain_key, array_to_string(list_transform(assignors, "
        f"lambda x: {_dec('x.pct_publisher')}), ';') AS pct_publisher_key FROM pairs")
    q["chn_restriction_meet"] = pair_ctes + (
        "SELECT DISTINCT array_to_string(chain, '|') AS chain_key, array_to_string(genre_incl, '|') AS genre_incl_key, "
        "array_to_string(catalog_incl, '|') AS catalog_incl_key, array_to_string(work_incl, '|') AS work_incl_key, "
        "array_to_string(genre_excl, '|') AS genre_excl_key, array_to_string(work_excl, '|') AS work_excl_key, "
        "is_void FROM pairs")
    q["fn_array_sets"] = pair_ctes + (
        "SELECT DISTINCT array_to_string(chain, '|') AS chain_key, array_to_string(territories, '|') AS territories_key, "
        f"CAST(len(territories) AS INTEGER) AS n_territories, coalesce(list_contains(territories, {W.COUNTRY}), false)"
        " AS has_country FROM pairs")
    sides = ctes(*CONTRACT_PARTS, _pair_sides())
    q["agg_first_percent"] = sides + (
        "SELECT a_chain[1] AS from_ctr, b_ors[1].role AS partner_role, "
        "CASE WHEN b_ors[1].role = 'E' THEN min(a_ors[1].pct_publisher) * min(b_ors[1].pct_publisher) / 100.0 "
        "ELSE min(a_ors[1].pct_publisher) END AS pct_publisher, min(a_ors[1].pct_creator) AS pct_creator "
        "FROM sides GROUP BY 1, 2")
    q["agg_collect_union"] = sides + (
        "SELECT DISTINCT a_chain[1] AS from_ctr, unnest(list_transform(b_ees, lambda x: x.catalog)) AS catalog "
        "FROM sides")
    q["agg_collect_intersect"] = sides + (
        "SELECT DISTINCT from_ctr, country FROM (SELECT a_chain[1] AS from_ctr, "
        "unnest(list_intersect(a_terr, b_terr)) AS country FROM sides)")
    q["chn_doubling"] = ctes(*CONTRACT_PARTS, _doubling(3)) + (
        "SELECT array_to_string(chain, '|') AS chain_key, array_to_string(cedant, '|') AS cedant_key, "
        "array_to_string(cess, '|') AS cess_key FROM dbl")
    rest = ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains"), static_keys_sql(), match_sql())
    q["win_longest_chain"] = rest + (
        "SELECT DISTINCT ide12, lettrage, orig AS numcatal_cedant_origine, array_to_string(ch, '|') AS chaine_contrats "
        "FROM w1")
    q["win_prorata"] = _restit() + (
        "SELECT ide12, lettrage, orig AS numcatal_cedant_origine, role_o AS role_ad_origine, gestnr, cle, "
        f"array_to_string(ch, '|') AS chaine_contrats, {round4('prorata')} AS prorata FROM s2")
    q["win_first_manager_pct"] = rest + (
        "SELECT ide12, lettrage, max(CASE WHEN role_o = 'E' AND gestnr = 1 THEN pe END) AS mgr_pct_publisher, "
        "max(CASE WHEN role_o = 'E' AND gestnr = 1 THEN pc END) AS mgr_pct_creator, "
        "CAST(sum(CASE WHEN gestnr <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_managed FROM w1 GROUP BY ide12, lettrage")
    q["rst_excluded_work"] = _restit() + (
        "SELECT ide12, lettrage, orig AS numcatal_cedant_origine, role_o AS role_ad_origine, "
        "cat_f AS numcatal_ayant_droit_final, role_f AS role_ad_final, array_to_string(ch, '|') AS chaine_contrats, "
        f"{round4('fin')} AS pct_final FROM s7")
    q["rst_residual"] = _restit() + (
        "SELECT DISTINCT ide12, lettrage, orig AS numcatal_cedant_origine, role_o AS role_ad_origine, "
        f"{round4('rest')} AS cle FROM s8 WHERE ch IS NOT NULL AND pe <> 100 AND gsum <> 100")
    q["snk_dated_chain_roundtrip"] = ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains")) + (
        "SELECT array_to_string(chain, '|') AS chain_key, assignor_catalog, assignor_role, pct_publisher, "
        "assignee_catalog, assignee_role, right_type FROM flat")
    legacy = (f"leg AS (SELECT DISTINCT {CHAIN_COLS} FROM (SELECT {combine_sql(legacy=True)} FROM "
              "(SELECT *, unnest(list_transform(assignees, lambda x: x.catalog)) AS k FROM lvl0 WHERE assignable = 1) a "
              "JOIN (SELECT *, unnest(list_transform(assignors, lambda x: x.catalog)) AS k FROM lvl0) b ON a.k = b.k))")
    q["chn_level1_legacy"] = ctes(*CONTRACT_PARTS, legacy) + chain_text_sql("leg")
    ctx = ctes(*CONTRACT_PARTS, levels_sql(W.MAX_DEPTH), flat_sql("chains"), static_keys_sql(batch=True),
               match_sql(), SHARES).replace(
        "FROM requests r JOIN contexts x ON r.num_contexte = x.num_contexte",
        "FROM (SELECT DISTINCT ide12 FROM oeuv) r JOIN contexts x ON x.num_contexte = 3")
    q["rst_restitution_context"] = ctx + f"SELECT {RESULT} FROM restit"
    q["win_last_value"] = ctes(TERR) + (
        "SELECT idtercmplx, leaf, incl AS final_incl FROM (SELECT *, row_number() OVER "
        "(PARTITION BY idtercmplx, leaf ORDER BY ord_list DESC, incl DESC) AS rn FROM t_el WHERE incl IN (0, 1)) "
        "WHERE rn = 1")
