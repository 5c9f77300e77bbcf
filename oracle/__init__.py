"""Independent DuckDB SQL for every registered query (the correctness oracle).

DuckDB has no spatial extension here, so the SQL never touches WKB: the
derived layers are boxes and points with integer-metre coordinates, and
intersects, overlap area, distance and centroids are plain arithmetic on
their bounds. Where an id is a hash of the WKB bytes, the little-endian
IEEE-754 bytes of each coordinate are assembled as hex text first.

The fixed values (text tables, dictionaries, constants) are imported from the
library so both sides use the same inputs; the logic is written separately.
"""

from __future__ import annotations

from footmark.functions import plus_codes as PC
from footmark.functions import projection as P
from footmark.functions import text as TX
from footmark.sources import fixtures as FX

WS = TX.WS


def q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def vlist(values) -> str:
    return "([" + ", ".join(q(v) for v in values) + "]::VARCHAR[])"


def strip_ws(s: str) -> str:
    return f"regexp_replace({s}, '^{WS}+|{WS}+\\z', '', 'g')"


def norm(s: str) -> str:
    return f"lower({strip_ws(s)})"


def to_double(s: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, '{TX.NUMERIC_RE}') THEN TRY_CAST({strip_ws(s)} AS DOUBLE) END)"


def to_int(s: str) -> str:
    return f"(CASE WHEN regexp_matches({s}, '{TX.INTEGER_RE}') THEN TRY_CAST({strip_ws(s)} AS INTEGER) END)"


def height_sql(h: str) -> str:
    v = (f"(CASE WHEN {h} IN ('0', '0.0') THEN NULL "
         f"WHEN contains({h}, ';') THEN list_max(list_transform(string_split({h}, ';'), lambda x: {to_double('x')})) "
         f"WHEN contains({h}, 'ft') THEN {to_double(strip_ws(f'regexp_replace({h}, ' + q('ft\\.?') + ', ' + q('') + ', ' + q('g') + ')'))} * {TX.FT_TO_M} "
         f"WHEN contains({h}, 'm') THEN {to_double(strip_ws(f'regexp_replace({h}, ' + q('^([^m]*)m') + ', ' + q('\\1') + ')'))} "
         f"WHEN ends_with({h}, '''') THEN {to_double(strip_ws(f'regexp_replace({h}, ' + q(chr(39) + '$') + ', ' + q('') + ')'))} * {TX.FT_TO_M} "
         f"ELSE {to_double(strip_ws(h))} END)")
    return f"(CASE WHEN {v} < 0 THEN NULL ELSE {v} END)"


def levels_sql(lv_raw: str, cls: str) -> str:
    lv = f"regexp_replace({lv_raw}, {q(TX.LEVELS_NOISE)}, '', 'g')"
    v = (f"(CASE WHEN {lv} IN ('0', 'Default') THEN NULL "
         f"WHEN {lv} IN ('Bi-Level', 'Split') THEN 2 "
         f"WHEN contains({lv}, ',') AND {cls} = 'school' THEN NULL "
         f"WHEN contains({lv}, '.5') THEN {to_int(f'regexp_replace({lv}, ' + q('(?s)\\.5.*') + ', ' + q('') + ')')} + 1 "
         f"WHEN regexp_matches({lv}, '1/2') THEN {to_int(strip_ws(f'replace({lv}, ' + q('1/2') + ', ' + q('') + ')'))} + 1 "
         f"WHEN contains({lv}, ',') THEN len(string_split({lv}, ','))::INTEGER "
         f"WHEN contains({lv}, ';') THEN list_max(list_transform(string_split({lv}, ';'), lambda x: {to_int('x')})) "
         f"WHEN contains({lv}, '-') THEN list_max(list_transform(string_split({lv}, '-'), lambda x: {to_int('x')})) "
         f"ELSE {to_int(lv)} END)")
    return f"(CASE WHEN {v} > 110 THEN NULL ELSE {v} END)::INTEGER"


# The oracle's own dictionaries (fixed values): street types, directions, units, name openers.
TYPES = ("aly alley ave avenue av avenue blvd boulevard cir circle ct court cv cove dr drive expy expressway fwy freeway hwy highway "
         "ln lane lp loop pkwy parkway pl place plz plaza rd road sq square st street ter terrace trl trail way way")
DIRS = "n north s south e east w west ne northeast nw northwest se southeast sw southwest"
UNIT = "apt apartment bldg building fl floor rm room ste suite unit unit # unit"
OPEN = "st saint ft fort mt mount"


def sql_map(words: str) -> str:
    w = words.split()
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in ({x: x for x in w[1::2]} | dict(zip(w[::2], w[1::2]))).items()) + "}"


def address_sql(a: str) -> str:
    """The address grammar, each step a one-element list that the next lambda names."""
    s = f"replace(regexp_replace(lower({a}), '[.,;]', ' ', 'g'), '#', ' # ')"
    s = strip_ws(f"regexp_replace({s}, '{WS}+', ' ', 'g')")
    for short, long_ in (("dr", "drive"), ("st", "street"), ("ct", "court"), ("ln", "lane"), ("ave", "avenue"), ("rd", "road")):
        s = f"regexp_replace({s}, '{WS}+{short}\\z', ' {long_}')"
    ty, di, un, op = map(sql_map, (TYPES, DIRS, UNIT, OPEN))

    def let(name: str, value: str, use: str) -> str:
        return f"list_transform([{value}], lambda {name}: {use})[1]"

    none = "[]::VARCHAR[]"
    name = (f"CASE WHEN len(x) < 2 THEN x WHEN {ty}[x[1]] IS NOT NULL AND regexp_full_match(x[2], '[a-z]|[0-9]+[a-z]?') "
            f"THEN [{ty}[x[1]]] || x[2:] ELSE [coalesce({op}[x[1]], x[1])] || x[2:] END")
    done = (f"CASE WHEN regexp_matches(array_to_string(x, ' '), '[a-z]') AND {un}[(hd || x)[1]] IS NULL "
            f"THEN array_to_string(hd || pre || {name} || suf || post || two, ' ') END")
    led = let("pre", f"CASE WHEN len(z) >= 2 AND {di}[z[1]] IS NOT NULL THEN [{di}[z[1]]] ELSE {none} END",
              let("x", "CASE WHEN len(pre) > 0 THEN z[2:] ELSE z END", done))
    typed = let("suf", f"CASE WHEN len(y) >= 2 AND {ty}[y[len(y)]] IS NOT NULL THEN [{ty}[y[len(y)]]] ELSE {none} END",
                let("z", "CASE WHEN len(suf) > 0 THEN y[:len(y) - 1] ELSE y END", led))
    street = let("post", f"CASE WHEN len(w) >= 2 AND {di}[w[len(w)]] IS NOT NULL AND NOT (len(w) = 2 AND {ty}[w[1]] IS NOT NULL) "
                         f"THEN [{di}[w[len(w)]]] ELSE {none} END",
                 let("y", "CASE WHEN len(post) > 0 THEN w[:len(w) - 1] ELSE w END", typed))
    at = ("coalesce(list_filter(range(1, len(one)), lambda i: regexp_full_match(one[i], '[0-9]+([a-z]|[-/][0-9]+)?') "
          f"AND (i = 1 OR {ty}[one[greatest(i - 1, 1)]] IS NULL))[1], 0)")
    numbers = let("nr", at, let("hd", "one[1:nr]", let("w", "one[nr + 1:]", street)))
    cut = f"coalesce(list_filter(range(2, len(t)), lambda i: {un}[t[i]] IS NOT NULL)[1], len(t) + 1)"
    lines = let("ct", cut, let("one", "t[1:ct - 1]", let("two", f"list_transform(t[ct:], lambda u: coalesce({un}[u], u))", numbers)))
    return f"(CASE WHEN {a} IS NOT NULL THEN {let('t', f'string_split({s}, ' + q(' ') + ')', lines)} END)"


def f64le(v: str) -> str:
    """Hex of the little-endian IEEE-754 bytes of an integer-valued double."""
    a = f"abs({v})"
    e0 = f"floor(log2({a}))::BIGINT"
    e = f"(CASE WHEN pow(2, {e0}) > {a} THEN {e0} - 1 WHEN pow(2, {e0} + 1) <= {a} THEN {e0} + 1 ELSE {e0} END)"
    mant = f"(({a} - pow(2, {e})) * pow(2, 52 - {e}))::UBIGINT"
    bits = (f"((CASE WHEN {v} < 0 THEN 9223372036854775808::UBIGINT ELSE 0::UBIGINT END) + "
            f"(({e} + 1023)::UBIGINT << 52) + {mant})")
    h = f"printf('%016x', {bits})"
    le = " || ".join(f"substr({h}, {i}, 2)" for i in range(15, 0, -2))
    return f"(CASE WHEN {v} = 0 THEN '0000000000000000' ELSE {le} END)"


def wkb_box_hash(x0, y0, x1, y1) -> str:
    X0, Y0, X1, Y1 = f64le(x0), f64le(y0), f64le(x1), f64le(y1)
    hexs = " || ".join(["'01030000000100000005000000'", X0, Y0, X1, Y0, X1, Y1, X0, Y1, X0, Y0])
    return f"sha256(base64(from_hex({hexs})))"


def wkb_point_hash(x, y) -> str:
    return f"sha256(base64(from_hex('0101000000' || {f64le(x)} || {f64le(y)})))"


def made_point_id(x, y, address) -> str:
    """Id of an address point that has none: from the point and the address."""
    return f"sha256(base64(from_hex('0101000000' || {f64le(x)} || {f64le(y)})) || coalesce({address}, ''))"


def albers_inverse_sql(x: str, y: str) -> tuple[str, str]:
    dy = f"({P.RHO0!r} - {y})"
    rho = f"sqrt({x} * {x} + {dy} * {dy})"
    theta = f"atan2({x}, {dy})"
    qq = f"(({P.C!r} - {rho} * {rho} * {P.N * P.N!r} / {P.A * P.A!r}) / {P.N!r})"
    beta = f"asin({qq} / {P.QP!r})"
    phi = f"({beta} + {P.S2!r} * sin({beta} * 2) + {P.S4!r} * sin({beta} * 4) + {P.S6!r} * sin({beta} * 6))"
    s = f"sin({phi})"
    w = f"(1.0 - {P.E2!r} * {s} * {s})"
    phi2 = (f"({phi} + {w} * {w} / (2.0 * cos({phi})) * ({qq} / {1 - P.E2!r} - {s} / {w} + "
            f"{1 / (2 * P.E)!r} * ln((1.0 - {P.E!r} * {s}) / (1.0 + {P.E!r} * {s}))))")
    lon = f"({P.LON0!r} + degrees({theta} / {P.N!r}))"
    return lon, f"degrees({phi2})"


def plus_code_sql(lat: str, lon: str, length: int = 13) -> str:
    grid = length - 10
    drop = PC.MAX_GRID_DIGITS - grid
    lat_c = f"least(greatest({lat}, -90.0), 90.0)"
    lat_v = f"least(floor(({lat_c} + 90.0) * {float(PC.LAT_CELLS_PER_DEGREE)}), {180 * PC.LAT_CELLS_PER_DEGREE - 1})"
    lon_n = f"((({lon}) + 180.0) % 360.0 + 360.0) % 360.0"
    lon_v = f"floor({lon_n} * {float(PC.LON_CELLS_PER_DEGREE)})"
    lat_v = f"floor({lat_v} / {5 ** drop})"
    lon_v = f"floor({lon_v} / {4 ** drop})"

    def dig(v):
        return f"substr('{PC.ALPHABET}', ({v})::INTEGER + 1, 1)"

    gd = []
    for i in range(grid):
        la = f"(floor({lat_v} / {5 ** (grid - 1 - i)}) % 5)"
        lo = f"(floor({lon_v} / {4 ** (grid - 1 - i)}) % 4)"
        gd.append(dig(f"{la} * 4 + {lo}"))
    lat_p = f"floor({lat_v} / {5 ** grid})"
    lon_p = f"floor({lon_v} / {4 ** grid})"
    pairs = []
    for i in range(5):
        d = 20 ** (4 - i)
        pairs.append(dig(f"floor({lat_p} / {d}) % 20"))
        pairs.append(dig(f"floor({lon_p} / {d}) % 20"))
    return "(" + " || ".join(pairs[:8] + ["'+'"] + pairs[8:] + gd) + ")"


def base_ctes() -> str:
    B, A, L, N = vlist(FX.BUILDING), vlist(FX.AMENITY), vlist(FX.LEISURE), vlist(FX.NAMES)
    S, U, LV, H = vlist(FX.STREETS), vlist(FX.UNITS), vlist(FX.LEVELS_TEXT), vlist(FX.HEIGHT_TEXT)
    NT, NS, OC = vlist(FX.NAD_TYPES), vlist(FX.NAD_SUB), vlist(FX.OCC_CLS)
    return f"""
slots AS (SELECT p_partkey AS k, (-2174000 + (p_partkey % 100) * 40)::DOUBLE AS gx,
  (2020000 + (p_partkey // 100) * 40)::DOUBLE AS gy, (10 + p_size % 10)::DOUBLE AS w,
  (8 + p_partkey % 5)::DOUBLE AS h FROM part),
top AS (SELECT greatest(2000.0, 1000.0 * ceil((2020000 + (max(k) // 100 + 2) * 40 - 2018000) / 6000.0)) AS high FROM (
  SELECT max(p_partkey) AS k FROM part UNION ALL SELECT max(c_custkey) FROM customer UNION ALL SELECT max(o_orderkey) // 8 FROM orders)),
osm_raw AS (SELECT k, CASE WHEN k % 7 <> 0 THEN 'osm-' || k::VARCHAR END AS osm_id,
  'way-' || k::VARCHAR AS osm_way_id, {B}[k % 9 + 1] AS building, {A}[k % 4 + 1] AS amenity,
  {L}[k % 2 + 1] AS leisure, {N}[k % 4 + 1] AS name,
  CASE WHEN k % 6 <> 0 THEN (k % 50 + 1)::VARCHAR END AS addr_housenumber,
  {S}[k % 8 + 1] AS addr_street, {U}[k % 4 + 1] AS addr_unit, {LV}[k % 21 + 1] AS building_levels,
  {H}[k % 13 + 1] AS height,
  CASE WHEN k % 11 = 3 THEN 'UniversityPly' WHEN k % 11 = 4 THEN 'Other' END AS dataset,
  gx AS bx0, gy + m AS by0, gx + w AS bx1, gy + m + h AS by1
  FROM (SELECT *, CASE WHEN k % 5 = 0 THEN 20 ELSE 0 END AS m FROM slots)),
ms_raw AS (SELECT k, (k % 9 - 2)::DOUBLE AS height, gx + (k % 7) * 2 AS bx0, gy + m AS by0,
  gx + (k % 7) * 2 + w AS bx1, gy + m + h AS by1
  FROM (SELECT *, CASE WHEN k % 3 = 0 THEN 20 ELSE 0 END AS m FROM slots)),
usa_raw AS (SELECT k, 'usa-' || k::VARCHAR AS UUID, {OC}[k % 5 + 1] AS OCC_CLS,
  CASE WHEN k % 3 <> 0 THEN concat_ws(' ', (k % 50 + 1)::VARCHAR, {S}[k % 8 + 1]) END AS PROP_ADDR,
  CASE WHEN k % 6 <> 0 THEN ((k % 12) * 1.5)::DOUBLE END AS HEIGHT,
  gx - 3 AS bx0, gy + m + (k % 4) * 3 AS by0, gx - 3 + w AS bx1, gy + m + (k % 4) * 3 + h AS by1
  FROM (SELECT *, CASE WHEN k % 2 <> 0 THEN 20 ELSE 0 END AS m FROM slots)),
nad_pts AS (SELECT c_custkey AS k,
  CASE WHEN c_custkey % 10 = 0 THEN {q(FX.NULL_UUID)} WHEN c_custkey % 10 = 5 THEN NULL
       ELSE 'nad-' || c_custkey::VARCHAR END AS UUID,
  {NT}[c_custkey % 5 + 1] AS Addr_Type,
  CASE WHEN c_custkey % 9 <> 0 THEN (c_custkey % 50 + 1)::VARCHAR END AS AddNo_Full,
  {S}[c_custkey % 8 + 1] AS StNam_Full, {NS}[c_custkey % 4 + 1] AS SubAddress,
  (-2174000 + (c_custkey % 100) * 40 + c_custkey % 13)::DOUBLE AS x,
  (2020000 + (c_custkey // 100) * 40 - (c_custkey % 8) * 2)::DOUBLE AS y FROM customer),
nad_raw AS (SELECT *, x AS bx0, y AS by0, x AS bx1, y AS by1 FROM nad_pts),
oa_pts AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 56 <> 9 THEN o_orderkey::VARCHAR END AS hash,
  (CASE WHEN o_orderkey % 24 = 4 THEN b + 1 ELSE b END)::VARCHAR AS number,
  CASE WHEN b % 50 <> 0 THEN {S}[b % 8 + 1] END AS street,
  CASE WHEN b % 4 = 1 THEN 'Apt 1' END AS unit,
  (-2174000 + (b % 100) * 40 + b % 13 + (b % 6) * 3)::DOUBLE AS x,
  (2020000 + (b // 100) * 40 - (b % 8) * 2)::DOUBLE AS y
  FROM (SELECT o_orderkey, o_orderkey // 8 AS b FROM orders) o),
oa_raw AS (SELECT *, x AS bx0, y AS by0, x AS bx1, y AS by1 FROM oa_pts),
counties AS (SELECT lpad((n_regionkey + 1)::VARCHAR, 2, '0') || lpad((n_nationkey * 4 + 1)::VARCHAR, 3, '0') AS fips,
  n_name AS county_name, r_name AS state_name, upper(substr(r_name, 1, 2)) AS state_abbr,
  (CASE WHEN n_nationkey >= 24 THEN -2160000.0 ELSE -2176000.0 + (n_nationkey % 4) * 2000.0 END)::DOUBLE AS cx0,
  (CASE WHEN n_nationkey >= 24 THEN 1520000.0 ELSE 2018000.0 + (n_nationkey // 4) * high END)::DOUBLE AS cy0,
  (CASE WHEN n_nationkey >= 24 THEN 20000.0 ELSE 2000.0 END)::DOUBLE AS csize,
  (CASE WHEN n_nationkey >= 24 THEN 20000.0 ELSE high END)::DOUBLE AS chigh
  FROM nation JOIN region ON n_regionkey = r_regionkey, top),
cty AS (SELECT *, cx0 + csize AS cx1, cy0 + chigh AS cy1 FROM counties)"""


# conformed layers; "{m}" is the masked source (raw rows with fips) or the raw rows
def conform_ctes(masked: bool) -> str:
    f = "fips, " if masked else ""
    fk = "fips, " if masked else ""

    def src(raw: str) -> str:
        if not masked:
            return raw
        return (f"(SELECT r.*, c.fips FROM {raw} r JOIN cty c ON r.bx0 <= c.cx1 AND c.cx0 <= r.bx1 "
                f"AND r.by0 <= c.cy1 AND c.cy0 <= r.by1)")

    oa_addr = norm("concat_ws(' ', number, street)")
    nad_addr = norm("concat_ws(' ', AddNo_Full, StNam_Full, SubAddress)")
    return f"""
osm_c0 AS (SELECT {f}k, coalesce(osm_id, osm_way_id) AS id,
  nullif(coalesce(building, amenity, leisure), 'yes') AS classification,
  concat_ws(' ', name, addr_housenumber, addr_street, addr_unit) AS address, height AS height_text,
  building_levels AS levels_text, dataset, bx0, by0, bx1, by1 FROM {src('osm_raw')} s WHERE building IS NOT NULL),
osm_conf AS (SELECT {f}'openstreetmap' AS provider, id, classification, address,
  {height_sql('height_text')} AS height, {levels_sql('levels_text', 'classification')} AS levels,
  bx0, by0, bx1, by1 FROM osm_c0
  WHERE (classification IS NULL OR classification NOT IN ('parking', 'parking_space'))
    AND (dataset IS NULL OR dataset <> 'UniversityPly')),
ms_conf AS (SELECT {f}'microsoft' AS provider, {wkb_box_hash('bx0', 'by0', 'bx1', 'by1')} AS id,
  NULL::VARCHAR AS classification, NULL::VARCHAR AS address,
  CASE WHEN height < 0 THEN NULL ELSE height END AS height, NULL::INTEGER AS levels,
  bx0, by0, bx1, by1 FROM {src('ms_raw')} s),
usa_conf AS (SELECT {f}'usa_structures' AS provider, UUID AS id,
  nullif({norm('OCC_CLS')}, '') AS classification, {norm('PROP_ADDR')} AS address,
  HEIGHT::DOUBLE AS height, NULL::INTEGER AS levels, bx0, by0, bx1, by1 FROM {src('usa_raw')} s),
nad_conf AS (SELECT {f}'nad' AS provider,
  CASE WHEN UUID = {q(FX.NULL_UUID)} THEN {wkb_point_hash('x', 'y')} ELSE coalesce(UUID, {made_point_id('x', 'y', nad_addr)}) END AS id,
  CASE WHEN Addr_Type IN ('Unknown', 'Other') THEN NULL ELSE Addr_Type END AS classification,
  {nad_addr} AS address,
  NULL::DOUBLE AS height, NULL::INTEGER AS levels, bx0, by0, bx1, by1 FROM {src('nad_raw')} s),
oa_b AS (SELECT DISTINCT {f}hash, number, street, unit, x, y FROM {src('oa_raw')} s),
oa_a AS (SELECT *, {oa_addr} AS address FROM oa_b),
oa_f AS (SELECT * FROM oa_a WHERE address IS NOT NULL AND address <> '0'),
oa_g AS (SELECT {fk}x, y, number, street, count(*) AS cnt, min({{'h': coalesce(hash, '~'), 'a': address}}) AS r FROM oa_f GROUP BY ALL),
oa_one AS (SELECT {fk}r, x, y FROM oa_g WHERE cnt = 1
  UNION ALL SELECT {fk}min(r) AS r, x, y FROM oa_g WHERE cnt > 1 GROUP BY ALL),
oa_id AS (SELECT *, r.a AS address, nullif(r.h, '~') AS id FROM oa_one),
oa_conf AS (SELECT {f}'openaddresses' AS provider, coalesce(id, {made_point_id('x', 'y', 'address')}) AS id, NULL::VARCHAR AS classification, address,
  NULL::DOUBLE AS height, NULL::INTEGER AS levels, x AS bx0, y AS by0, x AS bx1, y AS by1 FROM oa_id),
all_conf AS (SELECT * FROM osm_conf UNION ALL SELECT * FROM ms_conf UNION ALL SELECT * FROM usa_conf
  UNION ALL SELECT * FROM nad_conf UNION ALL SELECT * FROM oa_conf)"""


EMPTY_FOREIGN = "[]::STRUCT(provider VARCHAR, \"key\" VARCHAR)[]"
BASE = "fips, provider, id, classification, address, height, levels, \"foreign\", bx0, by0, bx1, by1"


def with_foreign(cte: str) -> str:
    return (f"(SELECT fips, provider, id, classification, address, height, levels, "
            f"{EMPTY_FOREIGN} AS \"foreign\", bx0, by0, bx1, by1 FROM {cte})")


def j7_ctes(name: str, left: str, right: str, use_distance: bool) -> str:
    """CTEs ``{name}`` = J7(left, right); left/right expose BASE columns."""
    if use_distance:
        dx = "greatest(l.bx0 - r.bx1, r.bx0 - l.bx1, 0.0)"
        dy = "greatest(l.by0 - r.by1, r.by0 - l.by1, 0.0)"
        cond = f"sqrt({dx} * {dx} + {dy} * {dy}) < 10.0"
    else:
        iw = "(least(l.bx1, r.bx1) - greatest(l.bx0, r.bx0))"
        ih = "(least(l.by1, r.by1) - greatest(l.by0, r.by0))"
        ar = "least((l.bx1 - l.bx0) * (l.by1 - l.by0), (r.bx1 - r.bx0) * (r.by1 - r.by0))"
        metric = f"(CASE WHEN {ar} = 0 THEN 'NaN'::DOUBLE ELSE greatest({iw}, 0.0) * greatest({ih}, 0.0) / {ar} END)"
        cond = f"{iw} >= 0 AND {ih} >= 0 AND {metric} > 0.3"
    return f"""
{name}_l AS (SELECT {BASE} FROM {left}),
{name}_r AS (SELECT {BASE} FROM {right}),
{name}_m AS (SELECT l.fips, l.provider, l.id, coalesce(l.classification, r.classification) AS classification,
  coalesce(l.address, r.address) AS address, coalesce(l.height, r.height) AS height,
  coalesce(l.levels, r.levels) AS levels,
  l."foreign" || r."foreign" || [struct_pack(provider := r.provider, "key" := r.id)] AS "foreign",
  l.bx0, l.by0, l.bx1, l.by1, r.provider AS rprov, r.id AS rid
  FROM {name}_l l JOIN {name}_r r ON l.fips = r.fips AND {cond}),
{name} AS (SELECT {BASE} FROM {name}_m
  UNION ALL SELECT {BASE} FROM {name}_l o WHERE NOT EXISTS (SELECT 1 FROM {name}_m m
    WHERE m.fips = o.fips AND m.provider = o.provider AND m.id = o.id)
  UNION ALL SELECT {BASE} FROM {name}_r o WHERE NOT EXISTS (SELECT 1 FROM {name}_m m
    WHERE m.fips = o.fips AND m.rprov = o.provider AND m.rid = o.id))"""


def foreign_text_sql(c: str) -> str:
    return (f"array_to_string(list_sort(list_transform({c}, lambda r: r.provider || ':' || "
            f"coalesce(r.\"key\", ''))), ',')")


def corr_select(cte: str) -> str:
    return (f"SELECT fips, provider, id, classification, address, height, levels, "
            f"{foreign_text_sql(chr(34) + 'foreign' + chr(34))} AS foreign_keys, "
            f"(bx0 + bx1) / 2 AS x, (by0 + by1) / 2 AS y FROM {cte}")


def footprint_fold_ctes() -> str:
    return (j7_ctes("fp1", with_foreign("osm_conf"), with_foreign("ms_conf"), False) + "," +
            j7_ctes("fp2", "fp1", with_foreign("usa_conf"), False))


def address_ctes() -> str:
    return j7_ctes("ad1", with_foreign("nad_conf"), with_foreign("oa_conf"), True)


def merge_ctes() -> str:
    dx = "greatest(a.bx0 - f.bx1, f.bx0 - a.bx1, 0.0)"
    dy = "greatest(a.by0 - f.by1, f.by0 - a.by1, 0.0)"
    d = f"sqrt({dx} * {dx} + {dy} * {dy})"
    addr = address_sql("raw")
    lon, lat = albers_inverse_sql("cx", "cy")
    return f"""
mg_p AS (SELECT a.fips, a.provider AS aprov, a.id AS aid, f.provider AS fprov, f.id AS fid,
  coalesce(a.classification, f.classification) AS classification, coalesce(a.address, f.address) AS address,
  coalesce(a.height, f.height) AS height, coalesce(a.levels, f.levels) AS levels,
  a."foreign" || f."foreign" || [struct_pack(provider := f.provider, "key" := f.id)] AS "foreign",
  {d} AS metric, (a.bx0 + a.bx1) / 2 AS acx, (a.by0 + a.by1) / 2 AS acy,
  (f.bx0 + f.bx1) / 2 AS fcx, (f.by0 + f.by1) / 2 AS fcy
  FROM ad1 a JOIN fp2 f ON a.fips = f.fips AND {d} < 10.0),
mg_n AS (SELECT * FROM mg_p QUALIFY metric = min(metric) OVER (PARTITION BY fips, fprov, fid)),
mg_all AS MATERIALIZED (
  SELECT fips, aprov AS provider, aid AS id, classification, address, height, levels, "foreign",
    CASE WHEN metric = 0 THEN acx ELSE fcx END AS cx, CASE WHEN metric = 0 THEN acy ELSE fcy END AS cy
  FROM mg_n
  UNION ALL SELECT fips, provider, id, classification, address, height, levels, "foreign",
    (bx0 + bx1) / 2, (by0 + by1) / 2 FROM fp2 o
    WHERE NOT EXISTS (SELECT 1 FROM mg_n m WHERE m.fips = o.fips AND m.fprov = o.provider AND m.fid = o.id)
  UNION ALL SELECT fips, provider, id, classification, address, height, levels, "foreign",
    (bx0 + bx1) / 2, (by0 + by1) / 2 FROM ad1 o
    WHERE NOT EXISTS (SELECT 1 FROM mg_n m WHERE m.fips = o.fips AND m.aprov = o.provider AND m.aid = o.id)),
mg_words AS MATERIALIZED (SELECT raw, {addr} AS long_hand FROM (SELECT DISTINCT address AS raw FROM mg_all WHERE address IS NOT NULL)),
mg_norm AS MATERIALIZED (SELECT fips, provider, id, classification, long_hand AS address, height, levels, "foreign", cx, cy
  FROM mg_all LEFT JOIN mg_words ON raw = address),
mg_addr AS (SELECT * FROM mg_norm WHERE address IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY fips, address ORDER BY provider NULLS FIRST, id NULLS FIRST,
    classification NULLS FIRST, height NULLS FIRST, levels NULLS FIRST, "foreign", cx, cy) = 1),
mg_rows AS (SELECT * FROM mg_addr UNION ALL SELECT * FROM mg_norm WHERE address IS NULL),
mg_d2 AS (SELECT * FROM mg_rows QUALIFY row_number() OVER (PARTITION BY fips, provider, id
    ORDER BY address NULLS FIRST, classification NULLS FIRST, height NULLS FIRST, levels NULLS FIRST,
    "foreign", cx, cy) = 1),
entities AS (SELECT fips, {plus_code_sql(lat, lon)} AS id, classification, address, height, levels,
  "foreign" || [struct_pack(provider := provider, "key" := id)] AS "foreign", cx AS x, cy AS y
  FROM mg_d2)"""


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def conform_out(cte: str) -> str:
    return (f"SELECT id, classification, address, height, levels, (bx0 + bx1) / 2 AS x, "
            f"(by0 + by1) / 2 AS y FROM {cte}")


def boxes() -> str:
    return ("(SELECT 'openstreetmap' AS provider, k AS \"key\", bx0, by0, bx1, by1 FROM osm_raw "
            "UNION ALL SELECT 'microsoft', k, bx0, by0, bx1, by1 FROM ms_raw "
            "UNION ALL SELECT 'usa_structures', k, bx0, by0, bx1, by1 FROM usa_raw)")


def triangle_ctes() -> str:
    """Both footprint layers as halves of their boxes: between a bottom line and a top line, each c + m * x
    with x and y from a corner of the slot. ``met`` has for pairs of boxes that meet the height of the common part
    at the places where any of the four lines cross (a concave polygon line): its area and largest height."""
    def half(table: str, upper: str) -> str:
        slope, at = "((by1 - by0) / (bx1 - bx0))", "(by0 - oy) - (bx0 - ox) * (by1 - by0) / (bx1 - bx0)"
        return (f"SELECT k, ox, oy, bx0, by0, bx1, by1, ({upper}) AS upper, (bx1 - bx0) * (by1 - by0) / 2 AS size, "
                f"CASE WHEN {upper} THEN {at} ELSE by0 - oy END AS bc, CASE WHEN {upper} THEN {slope} ELSE 0.0 END AS bm, "
                f"CASE WHEN {upper} THEN by1 - oy ELSE {at} END AS tc, CASE WHEN {upper} THEN 0.0 ELSE {slope} END AS tm "
                f"FROM (SELECT *, -2174000.0 AS ox, 2020000.0 AS oy FROM {table})")
    lines = ["bc, bm", "tc, tm", "dc, dm", "uc, um"]
    cross = [(p.split(", "), q_.split(", ")) for i, p in enumerate(lines) for q_ in lines[:i]]
    stops = ", ".join(f"CASE WHEN {m1} <> {m2} THEN least(greatest(({c2} - {c1}) / ({m1} - {m2}), x0), x1) ELSE x0 END"
                      for (c1, m1), (c2, m2) in cross)
    high = "least(tc + tm * x, uc + um * x) - greatest(bc + bm * x, dc + dm * x)"
    return (f"osm_half AS ({half('osm_raw', 'k % 2 = 1')}), ms_half AS ({half('ms_raw', 'k % 3 = 1')}), "
            "boxed AS (SELECT a.k AS lk, b.k AS rk, a.size AS ls, b.size AS rs, a.bc, a.bm, a.tc, a.tm, b.bc AS dc, b.bm AS dm, b.tc AS uc, "
            "b.tm AS um, greatest(a.bx0, b.bx0) - a.ox AS x0, least(a.bx1, b.bx1) - a.ox AS x1 FROM osm_half a JOIN ms_half b "
            "ON a.bx0 <= b.bx1 AND b.bx0 <= a.bx1 AND a.by0 <= b.by1 AND b.by0 <= a.by1), "
            f"stops AS (SELECT *, list_sort([x0, x1, {stops}]) AS xs FROM boxed), "
            f"heights AS (SELECT *, list_transform(xs, lambda x: {high}) AS hs FROM stops), "
            "met AS (SELECT lk, rk, ls, rs, list_max(hs) AS top, list_sum(list_transform(range(1, len(xs)), lambda i: "
            "(xs[i + 1] - xs[i]) * (greatest(hs[i], 0.0) + greatest(hs[i + 1], 0.0)) / 2)) AS area FROM heights)")


def oracle_sql() -> dict[str, str]:
    B = base_ctes()
    C0 = conform_ctes(False)
    C1 = conform_ctes(True)
    inter = "a.bx0 <= b.bx1 AND b.bx0 <= a.bx1 AND a.by0 <= b.by1 AND b.by0 <= a.by1"
    pdx = "greatest(a.bx0 - b.bx1, b.bx0 - a.bx1, 0.0)"
    pdy = "greatest(a.by0 - b.by1, b.by0 - a.by1, 0.0)"
    pd = f"sqrt({pdx} * {pdx} + {pdy} * {pdy})"
    iw = "(least(a.bx1, b.bx1) - greatest(a.bx0, b.bx0))"
    ih = "(least(a.by1, b.by1) - greatest(a.by0, b.by0))"
    ar = "least((a.bx1 - a.bx0) * (a.by1 - a.by0), (b.bx1 - b.bx0) * (b.by1 - b.by0))"
    lon_c, lat_c = albers_inverse_sql("(bx0 + bx1) / 2", "(by0 + by1) / 2")
    lon_p, lat_p = albers_inverse_sql("x", "y")
    osm_k = "SELECT k, bx0, by0, bx1, by1 FROM osm_raw"
    s = {}
    s["j1_intersects_join"] = with_(B) + f"SELECT a.k AS left_key, b.k AS right_key FROM osm_raw a JOIN ms_raw b ON {inter}"
    s["j2_dwithin_join"] = with_(B) + (f"SELECT a.k AS left_key, b.k AS right_key, round({pd}, 6) AS distance "
                                       f"FROM nad_raw a JOIN osm_raw b ON {pd} < 10.0")
    s["j4_overlap_correspondence"] = with_(B) + (
        f"SELECT left_key, right_key, area_intersection, area_relative, round(metric, 9) AS metric, "
        f"metric > 0.3 AS corresponds FROM (SELECT a.k AS left_key, b.k AS right_key, "
        f"greatest({iw}, 0.0) * greatest({ih}, 0.0) AS area_intersection, {ar} AS area_relative, "
        f"CASE WHEN {ar} = 0 THEN 'NaN'::DOUBLE ELSE greatest({iw}, 0.0) * greatest({ih}, 0.0) / {ar} END AS metric "
        f"FROM osm_raw a JOIN ms_raw b ON {inter})")
    s["j5_distance_correspondence"] = with_(B) + " UNION ALL ".join(
        f"SELECT a.k AS left_key, '{p}' AS right_provider, b.k AS right_key, round({pd}, 6) AS metric, {pd} < 10.0 AS corresponds "
        f"FROM nad_raw a JOIN {t} b ON {pd} < 40.0" for p, t in (("openaddresses", "oa_raw"), ("openstreetmap", "osm_raw")))
    s["g3_area"] = with_(B) + f"SELECT provider, \"key\", (bx1 - bx0) * (by1 - by0) AS area FROM {boxes()}"
    s["g12_bbox"] = with_(B) + f"SELECT provider, \"key\", bx0 AS xmin, by0 AS ymin, bx1 AS xmax, by1 AS ymax FROM {boxes()}"
    s["g5_g6_centroid_xy"] = with_(B) + f"SELECT provider, \"key\", (bx0 + bx1) / 2 AS x, (by0 + by1) / 2 AS y FROM {boxes()}"
    s["g8_centroid"] = s["g5_g6_centroid_xy"]
    pos = f"{iw} > 0 AND {ih} > 0"
    s["g4_intersection"] = with_(B) + (
        f"SELECT a.k AS left_key, b.k AS right_key, CASE WHEN {pos} THEN {iw} * {ih} ELSE 0.0 END AS area, "
        f"CASE WHEN {pos} THEN (greatest(a.bx0, b.bx0) + least(a.bx1, b.bx1)) / 2 END AS x, "
        f"CASE WHEN {pos} THEN (greatest(a.by0, b.by0) + least(a.by1, b.by1)) / 2 END AS y "
        f"FROM osm_raw a JOIN ms_raw b ON {inter}")
    s["g7_distance"] = with_(B) + f"SELECT a.k AS \"key\", round({pd}, 6) AS distance FROM nad_raw a JOIN osm_raw b ON a.k = b.k"
    s["g13_intersects"] = with_(B) + f"SELECT a.k AS \"key\", ({inter}) AS intersects FROM osm_raw a JOIN ms_raw b ON a.k = b.k"
    tri = triangle_ctes()
    third = {"x": "CASE WHEN upper THEN bx0 + bx0 + bx1 ELSE bx0 + bx1 + bx1 END", "y": "CASE WHEN upper THEN by0 + by1 + by1 ELSE by0 + by0 + by1 END"}
    s["g3_slanted_area"] = with_(B, tri) + " UNION ALL ".join(
        f"SELECT '{p}' AS provider, k AS \"key\", size AS area, " + ", ".join(f"round(({v}) / 3, 6) AS {c}" for c, v in third.items()) +
        f" FROM {t}" for p, t in (("openstreetmap", "osm_half"), ("microsoft", "ms_half")))
    s["g4_slanted_intersection"] = with_(B, tri) + ("SELECT lk AS left_key, rk AS right_key, round(area, 6) AS area, (area > 1e-9)::BIGINT AS n_polygons "
                                                    "FROM met WHERE top >= -1e-9")
    s["g13_slanted_intersects"] = with_(B, tri) + ("SELECT a.k AS \"key\", coalesce(m.top >= -1e-9, FALSE) AS intersects FROM osm_half a JOIN ms_half b "
                                                   "ON a.k = b.k LEFT JOIN met m ON m.lk = a.k AND m.rk = b.k")
    s["j4_slanted_overlap"] = with_(B, tri) + (
        "SELECT lk AS left_key, rk AS right_key, round(area, 6) AS area_intersection, least(ls, rs) AS area_relative, "
        "round(area / least(ls, rs), 9) AS metric, area / least(ls, rs) > 0.3 AS corresponds FROM met WHERE top >= -1e-9")
    corners = [("bx0", "by0"), ("bx1", "by1"), ("(CASE WHEN upper THEN bx0 ELSE bx1 END)", "(CASE WHEN upper THEN by1 ELSE by0 END)")]

    def to_side(i: int) -> str:
        (x1, y1), (x2, y2) = corners[i], corners[(i + 1) % 3]
        dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
        t = f"least(greatest(((x - {x1}) * {dx} + (y - {y1}) * {dy}) / ({dx} * {dx} + {dy} * {dy}), 0.0), 1.0)"
        return f"sqrt(pow(x - {x1} - {t} * {dx}, 2) + pow(y - {y1} - {t} * {dy}, 2))"

    beside = "(y - by0) * (bx1 - bx0) - (x - bx0) * (by1 - by0)"
    s["g7_slanted_distance"] = with_(B, tri) + (
        f"SELECT a.k AS \"key\", round(CASE WHEN x BETWEEN bx0 AND bx1 AND y BETWEEN by0 AND by1 AND CASE WHEN upper THEN {beside} >= 0 ELSE {beside} <= 0 END "
        f"THEN 0.0 ELSE least({', '.join(map(to_side, range(3)))}) END, 6) AS distance FROM (SELECT k, x, y FROM nad_raw) a JOIN osm_half b ON a.k = b.k")
    s["g10_explode_multipoint"] = with_(B) + (
        "SELECT k AS \"key\", p.x AS x, p.y AS y FROM osm_raw, "
        "unnest([{'x': bx0, 'y': by0}, {'x': bx1, 'y': by0}, {'x': bx1, 'y': by1}, {'x': bx0, 'y': by1}, "
        "{'x': bx0, 'y': by0}]) AS t(p)")
    s["g11_explode_multipolygon"] = with_(B) + (
        "SELECT k AS \"key\", (bx1 - bx0) * (by1 - by0) AS area, (bx0 + bx1) / 2 AS x, (by0 + by1) / 2 AS y FROM osm_raw "
        "UNION ALL SELECT k, (bx1 - bx0) * 5.0, (bx0 + bx1) / 2 + 20, by0 + 2.5 FROM osm_raw")
    s["g9_pluscode"] = with_(B) + f"SELECT k AS \"key\", {plus_code_sql(lat_c, lon_c)} AS code FROM osm_raw"
    s["p3_reproject"] = with_(B) + f"SELECT k AS \"key\", round({lon_p}, 7) AS lon, round({lat_p}, 7) AS lat FROM nad_raw"
    s["c1_conform_microsoft"] = with_(B, C0) + conform_out("ms_conf")
    s["c2_conform_nad"] = with_(B, C0) + conform_out("nad_conf")
    s["c3_conform_openaddresses"] = with_(B, C0) + conform_out("oa_conf")
    s["c4_conform_openstreetmap"] = with_(B, C0) + conform_out("osm_conf")
    s["c5_conform_usa_structures"] = with_(B, C0) + conform_out("usa_conf")
    s["c4h_height_parser"] = with_(B) + f"SELECT k AS \"key\", height AS height_text, {height_sql('height')} AS height FROM osm_raw"
    cls = "nullif(coalesce(building, amenity, leisure), 'yes')"
    s["c4l_levels_parser"] = with_(B) + (f"SELECT k AS \"key\", building_levels AS levels_text, {cls} AS classification, "
                                         f"{levels_sql('building_levels', cls)} AS levels FROM osm_raw")
    s["t1_normalize_str"] = (f"SELECT doc_id::BIGINT AS doc_id, sha256({norm('text')}) AS text_sha256, "
                             f"length({norm('text')})::BIGINT AS n_chars FROM documents")
    raw_addr = "concat_ws(' ', AddNo_Full, StNam_Full, SubAddress)"
    s["t6_normalize_address"] = with_(B) + (f"SELECT k AS \"key\", {raw_addr} AS raw_address, "
                                            f"{address_sql(raw_addr)} AS address FROM nad_raw")
    forms = "concat_ws(' ', (k % 97 + 1)::VARCHAR, " + vlist(FX.ADDRESS_FORMS) + f"[k % {len(FX.ADDRESS_FORMS)} + 1])"
    s["t6_address_grammar"] = with_(B) + f"SELECT k AS \"key\", {forms} AS raw_address, {address_sql(forms)} AS address FROM nad_raw"
    layers = [("openstreetmap", "osm_raw"), ("microsoft", "ms_raw"), ("usa_structures", "usa_raw"),
              ("nad", "nad_raw"), ("openaddresses", "oa_raw")]
    s["s2_county_mask"] = with_(B) + " UNION ALL ".join(
        f"SELECT '{p}' AS provider, r.k AS \"key\", c.fips FROM {t} r JOIN cty c ON r.bx0 <= c.cx1 "
        f"AND c.cx0 <= r.bx1 AND r.by0 <= c.cy1 AND c.cy0 <= r.by1" for p, t in layers)
    strips = ("(SELECT n_nationkey AS k, -2676000.0 AS bx0, 2018000.0 + n_nationkey * 100 AS by0, -1676000.0 AS bx1, "
              "2018050.0 + n_nationkey * 100 AS by1 FROM nation)")
    # the corner of the box (cut to the county's rectangle) that lies deepest in the triangle
    halves = (("1", "(greatest(r.by0, c.cy0) - c.cy0) * (c.cx1 - c.cx0) <= (least(r.bx1, c.cx1) - c.cx0) * (c.cy1 - c.cy0)"),
              ("2", "(least(r.by1, c.cy1) - c.cy0) * (c.cx1 - c.cx0) >= (greatest(r.bx0, c.cx0) - c.cx0) * (c.cy1 - c.cy0)"))
    code = "substr(c.fips, 1, 2) || lpad((substr(c.fips, 3)::INTEGER + {n} - 1)::VARCHAR, 3, '0')"
    s["s2_slanted_counties"] = with_(B) + " UNION ALL ".join(
        f"SELECT '{p}' AS provider, r.k AS \"key\", {code.format(n=n)} AS fips FROM {t} r JOIN cty c ON r.bx0 <= c.cx1 "
        f"AND c.cx0 <= r.bx1 AND r.by0 <= c.cy1 AND c.cy0 <= r.by1 AND {half}" for p, t in [*layers, ("outlier", strips)] for n, half in halves)
    mid = [(n, h.replace("greatest(r.by0, c.cy0)", "r.y").replace("least(r.by1, c.cy1)", "r.y").replace("least(r.bx1, c.cx1)", "r.x")
            .replace("greatest(r.bx0, c.cx0)", "r.x")) for n, h in halves]
    hits = " UNION ALL ".join(f"SELECT r.p, r.k, {code.format(n=n)} AS fips FROM mids r JOIN cty c ON r.x BETWEEN c.cx0 AND c.cx1 "
                              f"AND r.y BETWEEN c.cy0 AND c.cy1 AND {h}" for n, h in mid)
    s["j9_slanted_counties"] = with_(B, " mids AS (" + " UNION ALL ".join(
        f"SELECT '{p}' AS p, k, (bx0 + bx1) / 2 AS x, (by0 + by1) / 2 AS y FROM {t}" for p, t in [*layers, ("outlier", strips)]) + ")") + (
        f"SELECT m.p AS provider, m.k AS \"key\", h.fips FROM mids m LEFT JOIN (SELECT p, k, min(fips) AS fips FROM ({hits}) GROUP BY p, k) h "
        "ON h.p = m.p AND h.k = m.k")
    s["s10_read_counties"] = with_(B) + ("SELECT fips, county_name, state_name, state_abbr, round(cx0, 2)::DOUBLE AS xmin, round(cy0, 2)::DOUBLE AS ymin, "
                                         "round(cx1, 2)::DOUBLE AS xmax, round(cy1, 2)::DOUBLE AS ymax, 'ok' AS code FROM cty")
    s["j10_codes"] = with_(B) + (
        "SELECT a.code, a.n, c.county_name, coalesce(c.state_name, s.state_name) AS state_name FROM ("
        "SELECT code, count(*)::BIGINT AS n FROM (SELECT unnest([lpad((c_nationkey % 7 + 1)::VARCHAR, 2, '0'), "
        "lpad((c_nationkey % 7 + 1)::VARCHAR, 2, '0') || lpad((c_nationkey * 4 + 1)::VARCHAR, 3, '0')]) AS code FROM customer) GROUP BY code) a "
        "LEFT JOIN cty c ON c.fips = a.code LEFT JOIN (SELECT DISTINCT substr(fips, 1, 2) AS st, state_name FROM cty) s ON s.st = a.code")
    s["w7_w8_address_units"] = with_(B) + (
        "SELECT x, y, count(*)::BIGINT AS unit_count, min(hash) AS hash, "
        + ", ".join(f"arg_min({c}, k) FILTER ({c} IS NOT NULL) AS {c}" for c in ("number", "street", "unit")) + " FROM oa_raw GROUP BY x, y")
    s["j9_county_lookup"] = with_(B) + " UNION ALL ".join(
        f"SELECT '{p}' AS provider, r.k AS \"key\", (SELECT min(c.fips) FROM cty c WHERE "
        f"(r.bx0 + r.bx1) / 2 BETWEEN c.cx0 AND c.cx1 AND (r.by0 + r.by1) / 2 BETWEEN c.cy0 AND c.cy1) AS fips "
        f"FROM {t} r" for p, t in [("openstreetmap", "osm_raw"), ("nad", "nad_raw")])
    s["j10_county_names"] = with_(B) + (
        "SELECT l.\"key\", l.fips, c.county_name, c.state_name, c.state_abbr FROM (SELECT r.k AS \"key\", "
        "(SELECT min(c.fips) FROM cty c WHERE (r.bx0 + r.bx1) / 2 BETWEEN c.cx0 AND c.cx1 AND "
        "(r.by0 + r.by1) / 2 BETWEEN c.cy0 AND c.cy1) AS fips FROM osm_raw r) l LEFT JOIN cty c ON l.fips = c.fips")
    s["a4_state_bounds"] = with_(B) + (
        "SELECT s.state_fips, s.state_name, s.state_abbr, s.xmin, s.ymin, s.xmax, s.ymax, s.area, s.n_counties, "
        "s.area AS union_area, coalesce(f.n, 0)::BIGINT AS n_footprints FROM (SELECT substr(fips, 1, 2) AS state_fips, "
        "min(state_name) AS state_name, min(state_abbr) AS state_abbr, min(cx0) AS xmin, min(cy0) AS ymin, "
        "max(cx1) AS xmax, max(cy1) AS ymax, sum(csize * chigh)::DOUBLE AS area, count(*)::BIGINT AS n_counties "
        "FROM cty GROUP BY 1) s LEFT JOIN (SELECT substr(c.fips, 1, 2) AS state_fips, count(DISTINCT r.k) AS n "
        "FROM osm_raw r JOIN cty c ON r.bx0 <= c.cx1 AND c.cx0 <= r.bx1 AND r.by0 <= c.cy1 AND c.cy0 <= r.by1 "
        "GROUP BY 1) f ON s.state_fips = f.state_fips")
    s["c7_conform_pipeline"] = with_(B, C1) + (
        "SELECT fips, provider, id, classification, address, height, levels, (bx0 + bx1) / 2 AS x, "
        "(by0 + by1) / 2 AS y FROM all_conf")
    s["a1_provider_counts"] = with_(B, C1) + "SELECT fips, provider, count(*)::BIGINT AS n FROM all_conf GROUP BY ALL"
    J7 = j7_ctes("jx", with_foreign("osm_conf"), with_foreign("ms_conf"), False)
    s["j6_anti_join"] = with_(B, C1, J7) + (
        "SELECT fips, provider, id FROM jx_l o WHERE NOT EXISTS (SELECT 1 FROM jx_m m WHERE m.fips = o.fips "
        "AND m.provider = o.provider AND m.id = o.id)")
    s["j7_spatial_correspondence"] = with_(B, C1, J7) + corr_select("jx")
    s["j7_address_correspondence"] = with_(B, C1, address_ctes()) + corr_select("ad1")
    s["j7_footprint_fold"] = with_(B, C1, footprint_fold_ctes()) + corr_select("fp2")
    M = with_(B, C1, footprint_fold_ctes(), address_ctes(), merge_ctes())
    s["j8_merge"] = M + (f"SELECT fips, id, classification, address, height, levels, x, y, "
                         f"{foreign_text_sql(chr(34) + 'foreign' + chr(34))} AS foreign_keys FROM entities")
    s["c8_conflate_entities"] = M + "SELECT fips, id, classification, address, height, levels, x, y FROM entities"
    s["s8_crossref"] = M + ("SELECT fips, id AS entity_id, f.provider AS provider, f.\"key\" AS provider_id "
                            "FROM entities, unnest(\"foreign\") AS t(f)")
    s["s9_footprints"] = with_(B, C1, footprint_fold_ctes()) + (
        "SELECT fips, provider, id, min((bx0 + bx1) / 2) AS x, min((by0 + by1) / 2) AS y FROM fp2 GROUP BY ALL")
    s["s1_read_geojson"] = with_(B) + ("SELECT k AS \"key\", height AS height_text, (bx1 - bx0) * (by1 - by0) AS area, "
                                       "(bx0 + bx1) / 2 AS x, (by0 + by1) / 2 AS y FROM osm_raw")
    s["p3_forward"] = with_(B) + "SELECT k AS \"key\", round(bx0, 3)::DOUBLE AS x, round(by0, 3)::DOUBLE AS y FROM nad_raw"
    s["s4_write_conformed"] = s["c7_conform_pipeline"]
    s["s3_empty_input"] = with_(B, C1) + "SELECT fips, provider, count(*)::BIGINT AS n FROM osm_conf GROUP BY ALL"
    s["s5_skip_existing"] = s["a1_provider_counts"]
    s["s5_partition_manifest"] = with_(B, C1) + (
        "SELECT fips, provider, count(*)::BIGINT AS n, min(bx0)::DOUBLE AS xmin, min(by0)::DOUBLE AS ymin, "
        "max(bx1)::DOUBLE AS xmax, max(by1)::DOUBLE AS ymax, 'ok' AS state FROM all_conf GROUP BY fips, provider")
    s["s6_window_scan"] = s["c7_conform_pipeline"] + (
        ", (SELECT min(bx0)::DOUBLE AS x0, min(by0)::DOUBLE AS y0, max(bx1)::DOUBLE AS x1, max(by1)::DOUBLE AS y1 FROM all_conf) w "
        "WHERE bx0 <= x0 + (x1 - x0) / 4 AND by0 <= y0 + (y1 - y0) / 4")
    s["s2_pruned_read"] = s["c7_conform_pipeline"] + " WHERE substr(fips, 1, 2) = '01'"
    s["s7_write_entities"] = s["c8_conflate_entities"]
    s["o1_crossref_order"] = M + ("SELECT fips, count(*)::BIGINT AS n_rows, 0::BIGINT AS n_unsorted "
                                  "FROM entities, unnest(\"foreign\") AS t(f) GROUP BY fips")
    return s
