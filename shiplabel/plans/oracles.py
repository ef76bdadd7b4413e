"""The queries once more as plain SQL, to check results against another engine."""

from __future__ import annotations

from shiplabel.functions.text import WS
from shiplabel.operators import infer as I
from shiplabel.operators import requests as Q
from shiplabel.plans import views as V

ORACLES: dict[str, str] = {}


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _values(rows) -> str:
    cell = lambda v: str(v) if isinstance(v, int) else _text(v)
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm_value(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '{WS}+', ' ', 'g'))"


def digits(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    return (
        f"substr(CASE WHEN length({d}) = 9 THEN '0' || {d} "
        f"WHEN length({d}) BETWEEN 1 AND 3 THEN lpad({d}, 4, '0') ELSE {d} END, 1, 4)"
    )


def trunc(x: str) -> str:
    return f"lpad(substr({strip(x)}, 1, 4), 4, '0')"


def initcap(x: str) -> str:
    return (
        f"array_to_string([upper(w[1]) || lower(w[2:]) FOR w IN string_split(trim("
        f"regexp_replace({x}, '{WS}+', ' ', 'g')), ' ')], ' ')"
    )


def attr_name(x: str) -> str:
    return (
        f"array_to_string([upper(w[1]) || w[2:] FOR w IN "
        f"string_split(translate({strip(x)}, ' -', '__'), '_') IF w <> ''], '_')"
    )


SHIPMENTS = """shipments AS (
  SELECT concat_ws('|', lpad(CAST(l_orderkey AS VARCHAR), 10, '0'), CAST(l_linenumber AS VARCHAR),
                   lpad(CAST(l_partkey AS VARCHAR), 10, '0'), lpad(CAST(l_suppkey AS VARCHAR), 10, '0'),
                   lpad(CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), 3, '0'), l_returnflag, l_linestatus) AS ord,
         CAST(l_orderkey AS VARCHAR) AS shipment_id,
         CASE l_partkey % 4 WHEN 0 THEN '9011' WHEN 1 THEN '0901.11' WHEN 2 THEN '904' ELSE '901110000' END AS hs_code,
         CASE l_partkey % 7 WHEN 0 THEN upper(p_name) WHEN 1 THEN 'not ' || p_name
              WHEN 2 THEN p_name || ', 500 G/L' WHEN 3 THEN '  ' || p_type || '   ' || p_name || ' '
              WHEN 4 THEN p_name || 's' WHEN 5 THEN ' ' ELSE p_name || ' (' || p_brand || ')' END AS goods_shipped,
         p_type AS category, n_name AS shipment_origin, l_returnflag AS transport_method,
         l_quantity AS weight_in_kg, l_extendedprice AS value_of_goods_usd
  FROM lineitem JOIN part ON l_partkey = p_partkey
       JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""

DETAILED = f"""{SHIPMENTS}, detailed AS (
  SELECT *, CASE WHEN weight_in_kg < 10 THEN 'bag' WHEN weight_in_kg < 20 THEN 'BAG'
                 WHEN weight_in_kg < 35 THEN 'wooden  box' ELSE ' ' END AS packaging_type,
         'grade ' || CAST(CAST(weight_in_kg AS BIGINT) % 12 AS VARCHAR) AS "Screen-grade"
  FROM shipments)"""

CLEAN = f"""{SHIPMENTS}, clean AS (
  SELECT * REPLACE ({strip('goods_shipped')} AS goods_shipped) FROM shipments
  WHERE {strip('goods_shipped')} <> '')"""

ROWS = f"""{SHIPMENTS}, labelled AS (
  SELECT ord, {digits('hs_code')} AS hs_code, category AS product, {strip('goods_shipped')} AS goods_shipped,
         shipment_id
  FROM shipments WHERE {strip('goods_shipped')} <> ''),
goods AS (SELECT DISTINCT hs_code, product, goods_shipped FROM labelled)"""

GOODS = "hs_code, product, goods_shipped"
NEGATORS = "not|no|without|w o|minus|excluding|free of|free from|non"


def dictionary(only=tuple(V.ATTRIBUTES)) -> str:
    listed = [
        (attr, a, value, v)
        for a, (attr, values) in enumerate(V.ATTRIBUTES.items())
        if attr in only
        for v, value in enumerate(values)
    ]
    return f"""dict AS (
  SELECT hs_code, product, attr, attr_ord, value, value_ord
  FROM (VALUES {_values([(h,) for h in V.HEADINGS])}) h(hs_code),
       (VALUES {_values([(p,) for p in V.PRODUCTS])}) p(product),
       (VALUES {_values(listed)}) v(attr, attr_ord, value, value_ord)
  WHERE (product, attr) NOT IN ({', '.join(f"('{p}', '{a}')" for p, a in sorted(V.LACKING))})),
attrs AS (SELECT DISTINCT hs_code, product, attr, attr_ord FROM dict)"""


def matches(guarded: bool = True) -> str:
    """CTEs ``chosen`` (goods, attr, value) and ``blocked`` (goods, attr, number)."""
    accepted = "NOT negated" if guarded else "true"
    return f"""normed AS (SELECT *, ' ' || {norm_value('goods_shipped')} || ' ' AS norm FROM goods),
hits AS (
  SELECT {GOODS}, attr, value,
         CASE WHEN attr = 'Density' THEN '^(.*?[^a-z0-9])500 *(?:g|gr|grams) */? *(?:l|liter)(?:[^a-z0-9]|$)'
              ELSE '^(.*?[^a-z0-9])' || regexp_escape(lower(value)) || '(?:[^a-z0-9]|$)' END AS pattern, norm
  FROM normed JOIN dict USING (hs_code, product) WHERE length(value) >= 3),
judged AS (
  SELECT *, regexp_matches(trim(regexp_replace(right(regexp_extract(norm, pattern, 1), 28), '[^a-z0-9]+', ' ', 'g')),
                           '(^| )({NEGATORS})$') AS negated,
         row_number() OVER (PARTITION BY {GOODS}, attr ORDER BY length(value) DESC, value) AS nth
  FROM hits WHERE regexp_matches(norm, pattern)),
firsts AS (SELECT {GOODS}, attr, min(nth) FILTER (WHERE {accepted}) AS best, count(*) AS n
           FROM judged GROUP BY ALL),
chosen AS (SELECT {GOODS}, attr, value FROM judged JOIN firsts USING ({GOODS}, attr) WHERE nth = best),
blocked AS (SELECT {GOODS}, attr, {'coalesce(best - 1, n)' if guarded else '0'} AS blocked FROM firsts)"""


def items(only=tuple(V.ATTRIBUTES), size: int = 10) -> str:
    return f"""{ROWS}, {dictionary(only)}, {matches()},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY hs_code, product ORDER BY goods_shipped) - 1 AS k
  FROM goods SEMI JOIN dict USING (hs_code, product)),
states AS (SELECT {GOODS}, count(*) AS n_found FROM chosen GROUP BY ALL),
wanted AS (SELECT hs_code, product, count(*) AS n_attrs FROM attrs GROUP BY ALL),
items AS (
  SELECT {GOODS}, k // {size} AS batch_no, k % {size} AS pos, coalesce(n_found, 0) = n_attrs AS complete,
         bool_and(coalesce(n_found, 0) = n_attrs) OVER (PARTITION BY hs_code, product, k // {size}) AS resolved
  FROM ranked JOIN wanted USING (hs_code, product) LEFT JOIN states USING ({GOODS}))"""


ANSWERS = [
    '{"Color":"Red","Item":{"value":"Ring"}}',
    '{"Color":{"value":"Blue"},"Condition":{"custom":"Worn"}}',
    '{"Color":{"custom":"Crimson"},"Size":"Huge"}',
    '{"Color":null,"Density":{"custom":"450 G/L"}}',
    '{"Color":5,"Short":true}',
    '{"Color":"Unlisted","Size":{"other":1},"Item":"None"}',
    '{"Color":{"custom":"Red"},"Condition":{"value":3,"custom":"Old"}}',
]

REPLIES = f"""{items()},
parts AS (
  SELECT *, CASE WHEN batch_no % 8 = 4 AND pos = 1 THEN '"skip"'
                 WHEN length(goods_shipped) = 13 THEN '{{"item_preview":"zzz","attributes":"none"}}'
                 ELSE '{{"item_preview":"' || substr(goods_shipped, 1, 30) || '","attributes":' ||
                      ([{', '.join(_text(a) for a in ANSWERS)}])[(batch_no + pos) % 7 + 1] || '}}' END AS part
  FROM items),
bodies AS (
  SELECT hs_code, product, batch_no, count(*) AS size,
         string_agg(part, ',' ORDER BY pos) FILTER (WHERE batch_no % 8 <> 2 OR pos < last) ||
           CASE WHEN batch_no % 8 = 3 THEN ',{{"attributes":{{}}}}' ELSE '' END AS listed
  FROM (SELECT *, max(pos) OVER (PARTITION BY hs_code, product, batch_no) AS last FROM parts)
  GROUP BY hs_code, product, batch_no),
replies AS (
  SELECT hs_code, product, batch_no, size,
         CASE batch_no % 8 WHEN 5 THEN 'no answer {{'
              WHEN 6 THEN 'Sure: {{"items":[' || coalesce(listed, '') || ']}} done'
              ELSE '{{"items":[' || coalesce(listed, '') || ']}}' END AS reply
  FROM bodies WHERE batch_no % 8 <> 7)"""

ALIGNED = f"""{REPLIES},
payloads AS (SELECT *, nullif(regexp_extract(reply, '(?s)\\{{.*\\}}'), '') AS payload FROM replies),
documents_read AS (SELECT *, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS doc FROM payloads),
placed AS (
  SELECT i.*, r.batch_no IS NOT NULL AS answered,
         CASE WHEN i.pos < r.size THEN json_extract(doc, '$.items[' || CAST(pos AS VARCHAR) || ']') END AS entry
  FROM items i LEFT JOIN documents_read r USING (hs_code, product, batch_no)),
usable AS (
  SELECT *, CASE WHEN json_type(entry) = 'OBJECT' THEN entry END AS item,
         bool_or(coalesce(json_type(entry) = 'OBJECT', false)) OVER (PARTITION BY hs_code, product, batch_no) AS any_item
  FROM placed),
aligned AS (
  SELECT *, CASE WHEN NOT answered THEN 'pending' WHEN NOT any_item THEN 'unusable'
                 WHEN item IS NULL THEN 'pending' ELSE 'answered' END AS status,
         CASE WHEN item IS NOT NULL THEN coalesce(starts_with(substr(goods_shipped, 1, 30),
              substr(json_extract_string(item, '$.item_preview'), 1, 15)), true) END AS preview_ok
  FROM usable)"""


def judged_replies(open_list: bool = True) -> str:
    keep = "foreign_value AND (nested OR true)" if open_list else "foreign_value AND nested"
    return f"""{ALIGNED},
given AS (
  SELECT a.hs_code, a.product, a.goods_shipped, a.status, attr, attr_ord, item, batch_no, pos,
         json_extract(json_extract(item, '$.attributes'), '$."' || attr || '"') AS raw
  FROM aligned a JOIN attrs USING (hs_code, product) WHERE status <> 'pending'),
typed AS (
  SELECT *, coalesce(json_type(raw), 'NULL') AS kind, json_type(raw, '$.value') AS inner_kind,
         json_type(raw, '$.custom') AS custom_kind FROM given),
texts AS (
  SELECT *, kind = 'OBJECT' AND coalesce(inner_kind, '') <> 'VARCHAR' AND coalesce(custom_kind, '') = 'VARCHAR' AS nested,
         CASE WHEN status = 'unusable' OR kind = 'NULL' THEN 'None'
              WHEN kind = 'OBJECT' AND inner_kind = 'VARCHAR' THEN json_extract_string(raw, '$.value')
              WHEN kind = 'OBJECT' AND custom_kind = 'VARCHAR' THEN json_extract_string(raw, '$.custom')
              WHEN kind = 'OBJECT' THEN 'None'
              WHEN kind = 'BOOLEAN' THEN upper(substr(CAST(raw AS VARCHAR), 1, 1)) || substr(CAST(raw AS VARCHAR), 2)
              ELSE json_extract_string(raw, '$') END AS said FROM typed),
foreigns AS (
  SELECT t.*, said <> 'None' AND d.value IS NULL AS foreign_value
  FROM texts t LEFT JOIN (SELECT DISTINCT hs_code, product, attr, value FROM dict) d
       ON t.hs_code = d.hs_code AND t.product = d.product AND t.attr = d.attr AND t.said = d.value),
replied AS (
  SELECT {GOODS}, status, attr, attr_ord, batch_no, pos,
         CASE WHEN foreign_value AND NOT ({keep}) THEN 'None' ELSE said END AS value,
         {keep} AS custom, ({keep}) AND {str(open_list).lower()} AS out_of_schema, foreign_value AND NOT ({keep}) AS invalid
  FROM foreigns),
merged AS (
  SELECT r.* REPLACE (CASE WHEN status = 'answered' THEN coalesce(c.value, r.value) ELSE r.value END AS value,
                      r.custom AND NOT (status = 'answered' AND c.value IS NOT NULL) AS custom)
  FROM replied r LEFT JOIN chosen c USING ({GOODS}, attr)),
softs AS (SELECT DISTINCT {GOODS}, translate(lower(goods_shipped), '#,;/\\()', '       ') AS soft FROM merged),
spots AS (SELECT s.*, attr, value, lower(value) AS low, strpos(soft, lower(value)) AS p
          FROM softs s JOIN dict USING (hs_code, product)),
guesses AS (
  SELECT {GOODS}, attr, arg_min(value, (-length(value), value)) AS guess FROM spots
  WHERE p > 0 AND (p = 1 OR regexp_matches(substr(soft, p - 1, 1), '{WS}'))
    AND (p + length(low) > length(soft) OR regexp_matches(substr(soft, p + length(low), 1), '{WS}'))
  GROUP BY ALL),
filled AS (
  SELECT m.* REPLACE (CASE WHEN m.value = 'None' THEN coalesce(guess, 'None') ELSE m.value END AS value),
         m.value = 'None' AND guess IS NOT NULL AS filled
  FROM merged m LEFT JOIN guesses USING ({GOODS}, attr))"""


def _attribute_columns(value: str = "value", flags: bool = False) -> str:
    columns = []
    for a in V.ATTRIBUTES:
        columns.append(f"max({value}) FILTER (WHERE attr = '{a}') AS \"attr_{a}\"")
        if flags:
            columns.append(
                f"CAST(max(CAST(custom AS INTEGER)) FILTER (WHERE attr = '{a}') AS INTEGER) AS \"attr_{a}_is_custom\""
            )
    return ", ".join(columns)


SAFE = "regexp_replace(trim(regexp_replace({p}, '[^\\p{{L}}\\p{{N}} _-]', '_', 'g')), ' +', '_', 'g')"


def product_file(hs: str, product: str) -> str:
    safe = SAFE.format(p=product)
    return f"'hs_' || {hs} || '_' || coalesce(nullif(substr({safe}, 1, 120), ''), 'product') || '.csv'"


FLAT = f"""{ROWS}, {dictionary()}, {matches()},
full_values AS (
  SELECT {GOODS}, attr, attr_ord, coalesce(value, 'None') AS value
  FROM goods JOIN attrs USING (hs_code, product) LEFT JOIN chosen USING ({GOODS}, attr)),
pivoted AS (SELECT {GOODS}, {_attribute_columns()} FROM full_values GROUP BY ALL),
flat AS (SELECT l.ord, l.shipment_id, p.* FROM labelled l JOIN pivoted p USING ({GOODS}))"""


def cte(prefix: str, select: str) -> str:
    return f"WITH {prefix}\n{select}"


# --- sources -----------------------------------------------------------------

ORACLES["clean_shipments"] = cte(CLEAN, "SELECT ord, hs_code, goods_shipped, shipment_id FROM clean")
ORACLES["filtered_scan"] = cte(
    SHIPMENTS,
    f"""SELECT ord, substr(hs_code, 1, 4) AS hs_code, {strip('goods_shipped')} AS goods_shipped, shipment_id,
       transport_method FROM shipments WHERE hs_code = '901110000' AND transport_method = 'A'""",
)
ORACLES["profile_shipments"] = cte(
    CLEAN,
    """SELECT count(*) AS rows, count(DISTINCT hs_code) AS hs_codes, count(DISTINCT goods_shipped) AS goods,
       count(DISTINCT shipment_id) AS shipments, count(*) FILTER (WHERE hs_code <> '') AS filled_hs_codes,
       count(*) FILTER (WHERE goods_shipped <> '') AS filled_goods,
       count(*) FILTER (WHERE shipment_id <> '') AS filled_shipments FROM clean""",
)
ORACLES["product_def"] = """
SELECT hs_code, CAST(row_number() OVER (PARTITION BY hs_code ORDER BY category) - 1 AS INTEGER) AS ord, category,
       'Goods of type ' || category AS description
FROM (SELECT DISTINCT p_brand AS hs_code, p_type AS category FROM part)"""
ORACLES["attr_dict"] = """
WITH sizes AS (SELECT DISTINCT p_brand, p_type, p_size FROM part)
SELECT p_brand AS hs_code, p_type AS product, 'Size' AS attr, CAST(0 AS INTEGER) AS attr_ord,
       CAST(p_size AS VARCHAR) AS value,
       CAST(row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_size) - 1 AS INTEGER) AS value_ord FROM sizes
UNION ALL SELECT DISTINCT p_brand, p_type, 'Brand', CAST(1 AS INTEGER), p_brand, CAST(0 AS INTEGER) FROM sizes
UNION ALL SELECT DISTINCT p_brand, p_type, 'Nothing', CAST(2 AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS INTEGER)
FROM sizes"""
ORACLES["classified_input"] = cte(
    SHIPMENTS,
    f"""SELECT {trunc('hs_code')} AS hs_code, category AS product, {strip('goods_shipped')} AS goods_shipped,
       shipment_id, ord FROM shipments""",
)
ORACLES["generated_shipment_ids"] = cte(
    SHIPMENTS,
    f"""SELECT {digits('hs_code')} AS hs_code, category AS product, {strip('goods_shipped')} AS goods_shipped,
       CAST(row_number() OVER (ORDER BY ord) AS VARCHAR) AS shipment_id, ord FROM shipments""",
)

# --- scalar functions --------------------------------------------------------

ORACLES["hs4_codes"] = f"""
WITH codes AS (
  SELECT DISTINCT unnest([CAST(p_partkey AS VARCHAR), ' ' || CAST(p_partkey AS VARCHAR) || '.10',
                          CAST(p_partkey AS VARCHAR) || '1100000', p_brand, p_type]) AS code FROM part)
SELECT code, {trunc('code')} AS by_position, {digits('code')} AS by_digits,
       coalesce(nullif(regexp_extract('0' || code, '^0+([0-9].*)$', 1), ''), '0' || code) AS as_number
FROM codes"""
ORACLES["norm_text"] = f"SELECT doc_id, ' ' || {norm_value('text')} || ' ' AS norm FROM documents"
_FILE = product_file("'9011'", "product")
ORACLES["file_names"] = f"""
WITH named AS (SELECT DISTINCT p_type || ' ' || p_name || '/' || p_brand || '  é-x.y' AS product FROM part),
files AS (SELECT product, {_FILE} AS file, product AS other FROM named),
bases AS (SELECT *, string_split(regexp_replace(file, '\\.[^.]*$', ''), '_') AS parts,
                 string_split(regexp_replace(regexp_replace(other, '^.*/', ''), '\\.[^.]*$', ''), '_') AS others FROM files)
SELECT product, file, trim(replace(array_to_string(parts[3:], ' '), '  ', ' ')) AS from_file,
       trim(replace(array_to_string(CASE WHEN len(others) > 2 THEN others[3:] ELSE others END, ' '), '  ', ' ')) AS from_other
FROM bases"""


def _snake(x: str) -> str:
    s = f"regexp_replace({x}, '(?:-|{WS})+', '_', 'g')"
    s = f"regexp_replace({s}, '([A-Z]+)([A-Z][a-z])', '\\1_\\2', 'g')"
    s = f"regexp_replace({s}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')"
    return f"trim(lower(regexp_replace({s}, '_+', '_', 'g')), '_')"


ORACLES["snake_names"] = f"""
WITH named AS (
  SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN 'attr_' ELSE '' END || p_type ||
         replace({initcap('p_name')}, ' ', '') || '-' || p_brand || ' __Value' AS name FROM part)
SELECT name, {_snake('name')} AS acronym,
       CASE WHEN starts_with(name, 'attr_') THEN {_snake('substr(name, 6)')} ELSE {_snake('name')} END AS dropped,
       CASE WHEN starts_with(name, 'attr_') THEN 'attr_' || {_snake('substr(name, 6)')} ELSE {_snake('name')} END AS kept,
       lower(trim(regexp_replace(regexp_replace(name, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g'), '_'))
         AS simple
FROM named"""
ORACLES["clean_values"] = f"""
WITH raws AS (
  SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'None' WHEN 1 THEN '"NaN"' WHEN 2 THEN ' n/a '
         WHEN 3 THEN '''' || p_name || '''' WHEN 4 THEN ' "' || p_name || '" ' WHEN 5 THEN 'undefined' WHEN 6 THEN '  '
         WHEN 7 THEN chr(9) || p_brand || chr(10) ELSE p_name END AS raw FROM part),
trimmed AS (SELECT p_partkey, {strip('raw')} AS s, trim(trim({strip('raw')}, '"'), '''') AS q FROM raws)
SELECT p_partkey, CASE WHEN lower(q) NOT IN ('', 'none', 'null', 'nan', 'na', 'n/a', 'undefined') THEN q END AS in_summary,
       CASE WHEN lower(s) NOT IN ('', 'nan', 'none', 'null') THEN s END AS in_map FROM trimmed"""
ORACLES["attr_names"] = f"""
WITH raws AS (SELECT DISTINCT ' -' || p_name || '--' || p_type || ' ' || lower(p_type) || '_' AS raw FROM part)
SELECT raw, {attr_name('raw')} AS name, 'attr_' || {attr_name('raw')} AS key FROM raws"""
ORACLES["title_values"] = f"""
WITH listed AS (
  SELECT p_partkey, unnest([p_name, upper(p_name), '  ' || p_type || '-x  ' || p_name, ' ', p_brand]) AS v,
         unnest([1, 2, 3, 4, 5]) AS i FROM part),
titled AS (SELECT p_partkey, i, {initcap('v')} AS t FROM listed),
firsts AS (SELECT p_partkey, t, min(i) AS i FROM titled WHERE t <> '' GROUP BY ALL)
SELECT p_partkey, string_agg(t, '|' ORDER BY i) AS titles FROM firsts GROUP BY p_partkey"""
ORACLES["value_patterns"] = f"""
WITH listed AS (
  SELECT DISTINCT p_type AS product, unnest([p_name, ' ' || upper(p_name) || ' ', CAST(p_size + 480 AS VARCHAR) || ' G/L',
         CAST(p_size + 90 AS VARCHAR) || '  gl', substr(p_name, 1, 2)]) AS value FROM part),
normed AS (SELECT *, CASE WHEN length({strip('value')}) >= 3 THEN {norm_value('value')} END AS n FROM listed),
spelled AS (SELECT *, row_number() OVER (PARTITION BY product, n ORDER BY value) AS nth FROM normed),
kept AS (SELECT product, value, CASE WHEN nth = 1 THEN n END AS norm FROM spelled)
SELECT product, value, norm,
       regexp_matches(replace(norm, ' ', ''), '\\b[0-9]{{3,4}}g/?l\\b') OR contains(norm, 'g/l') OR contains(norm, 'gr/l')
         OR contains(norm, 'grams/liter') AS density,
       CASE WHEN norm IS NOT NULL THEN array_to_string(regexp_extract_all(norm, '[0-9]+'), ',') END AS numbers
FROM kept"""

# --- filters and profiles ----------------------------------------------------

ORACLES["hs_filter"] = cte(
    f"{ROWS}, {dictionary()}",
    """SELECT ord, hs_code FROM labelled WHERE hs_code IN ('0901', '0904')
       AND hs_code IN (SELECT hs_code FROM dict)""",
)
ORACLES["hs4_available"] = cte(
    SHIPMENTS, f"SELECT DISTINCT {digits('hs_code')} AS hs4 FROM shipments WHERE {digits('hs_code')} <> ''"
)
ORACLES["heading_rows"] = cte(
    SHIPMENTS, f"SELECT ord, hs_code FROM shipments WHERE {digits('hs_code')} = '0901'"
)


def _first_values(columns, limit: int | None, source: str = "detailed", by: str = "category") -> str:
    melted = " UNION ALL ".join(
        f"SELECT {by}, ord, {_text(c)} AS \"column\", {i} AS rank, {strip(f'CAST(\"{c}\" AS VARCHAR)')} AS value FROM {source}"
        for i, c in enumerate(columns)
    )
    return f"""melted AS ({melted}),
first_seen AS (SELECT {by}, "column", rank, lower(value) AS key, arg_min(value, (ord, value)) AS value, min(ord) AS ord
               FROM melted WHERE value IS NOT NULL AND value <> '' GROUP BY {by}, "column", rank, lower(value)),
first_values AS (
  SELECT * FROM (SELECT {by}, "column", rank, value,
                        row_number() OVER (PARTITION BY {by}, "column" ORDER BY ord, value) AS place FROM first_seen)
  WHERE {'true' if limit is None else f'place <= {limit}'})"""


_SUMMARY_COLUMNS = [
    "shipment_origin", "transport_method", "value_of_goods_usd", "weight_in_kg", "packaging_type", "Screen-grade",
]
SUMMARY = f"""{_first_values(_SUMMARY_COLUMNS, 8)},
lines AS (SELECT category, rank, "column", "column" || ': ' || string_agg(value, ', ' ORDER BY place) AS line
          FROM first_values GROUP BY category, rank, "column"),
hints AS (SELECT category, string_agg(DISTINCT word, ', ' ORDER BY word) AS hint
          FROM lines JOIN (VALUES ('packaging_type', 'pack'), ('packaging_type', 'type'), ('Screen-grade', 'screen'),
                                  ('Screen-grade', 'grade')) w("column", word) USING ("column") GROUP BY category),
summaries AS (
  SELECT category, string_agg(line, chr(10) ORDER BY rank) ||
         coalesce(chr(10) || '{I.KEYWORD_LINE}' || any_value(hint), '') AS summary
  FROM lines LEFT JOIN hints USING (category) GROUP BY category)"""
ORACLES["category_summary"] = cte(f"{DETAILED}, {SUMMARY}", "SELECT category, summary FROM summaries")
ORACLES["top_values"] = cte(
    f"{DETAILED}, "
    + _first_values(
        ["shipment_origin", "transport_method", "weight_in_kg", "value_of_goods_usd", "packaging_type", "goods_shipped"], 5
    ),
    'SELECT category, "column", place, value FROM first_values',
)
_DISTRIBUTION = """SELECT {c} AS category, count(*) AS rows,
       round(100.0 * count(*) / (SELECT count(*) FROM {t}), 1) AS percent FROM {t} GROUP BY {c}"""
ORACLES["category_distribution"] = cte(SHIPMENTS, _DISTRIBUTION.format(c="category", t="shipments"))
ORACLES["event_distribution"] = _DISTRIBUTION.format(c="event_type", t="events")
ORACLES["dedup_stats"] = cte(
    SHIPMENTS,
    """SELECT count(*) AS rows, count(DISTINCT goods_shipped) AS goods, count(DISTINCT category) AS categories,
       round(count(DISTINCT goods_shipped) / count(*), 6) AS ratio FROM shipments""",
)

for _name in ("profile_shipments", "dedup_stats", "category_distribution"):
    ORACLES[_name.removesuffix("_shipments") + "_of_deliveries"] = ORACLES[_name]

# --- dictionary matching -----------------------------------------------------

_PER_ROW = f"SELECT ord, hs_code, product, attr, value FROM labelled JOIN chosen USING ({GOODS})"
_MATCH = cte(f"{ROWS}, {dictionary()}, {matches()}", _PER_ROW)
for _name in ("deterministic_match", "deterministic_match_anchored", "streamed_match"):
    ORACLES[_name] = _MATCH
ORACLES["two_streamed_deliveries"] = cte(
    f"{ROWS}, {dictionary()}, {matches()}",
    f"SELECT DISTINCT {GOODS}, shipment_id, attr, value FROM labelled JOIN chosen USING ({GOODS})",
)
_LOT = "shipment_id || ' ' || split_part(ord, '|', 2)"
ORACLES["match_of_lots"] = cte(
    f"""{ROWS.replace('labelled AS', 'named AS', 1).split('goods AS')[0]} labelled AS (
  SELECT ord, hs_code, product, goods_shipped || ' lot ' || {_LOT} AS goods_shipped, shipment_id FROM named WHERE hs_code = '9011'),
goods AS (SELECT DISTINCT hs_code, product, goods_shipped FROM labelled), {dictionary()}, {matches()}""",
    f"""{_PER_ROW} UNION ALL
  SELECT ord, hs_code, product, 'Lot' AS attr, 'Lot ' || {_LOT} AS value FROM labelled
  WHERE CAST(shipment_id AS BIGINT) % 5 <> 0 AND product IN ({', '.join(_text(x) for x in V.PRODUCTS)})""",
)
ORACLES["density_match"] = cte(f"{ROWS}, {dictionary(('Density',))}, {matches()}", _PER_ROW)


def _guard(mode: str, guarded: bool) -> str:
    return f"""(WITH {dictionary()}, {matches(guarded)}
  SELECT '{mode}' AS mode, g.hs_code, g.product, g.goods_shipped, a.attr, c.value,
         CAST(coalesce(blocked, 0) AS BIGINT) AS blocked
  FROM goods g JOIN attrs a USING (hs_code, product) LEFT JOIN chosen c USING ({GOODS}, attr)
       LEFT JOIN blocked USING ({GOODS}, attr))"""


ORACLES["negation_guard"] = cte(
    ROWS, f"SELECT * FROM {_guard('documented', True)} UNION ALL SELECT * FROM {_guard('inert', False)}"
)
ORACLES["match_coverage"] = cte(
    f"{ROWS}, {dictionary()}, {matches()}",
    f"""SELECT (SELECT count(*) FROM (SELECT DISTINCT {GOODS} FROM chosen)) AS rows_with_any_match,
       (SELECT count(*) FROM goods SEMI JOIN dict USING (hs_code, product)) AS rows_total,
       (SELECT count(*) FROM chosen) AS attribute_matches,
       (SELECT count(*) FROM goods JOIN attrs USING (hs_code, product)) AS attribute_attempted,
       round((SELECT count(*) FROM chosen) / (SELECT count(*) FROM goods JOIN attrs USING (hs_code, product)), 6)
         AS attribute_match_rate,
       CAST((SELECT sum(blocked) FROM blocked) AS BIGINT) AS negation_blocked""",
)
_DOCUMENT_VALUES = {
    "Article": ["the", "der", "les", "The Und", "des"],
    "Accent": ["où", "und", "è", "été", "für den", "que les"],
    "Number": ["100", "2024", "3.5"],
}
ORACLES["document_match"] = f"""
WITH vals AS (
  SELECT * FROM (VALUES {_values([(a, v) for a, vs in _DOCUMENT_VALUES.items() for v in vs])}) v(attr, value)
  WHERE length(value) >= 2),
normed AS (SELECT doc_id, ' ' || {norm_value('text')} || ' ' AS norm FROM documents),
hits AS (
  SELECT doc_id, attr, value, norm, '^(.*?[^a-z0-9])' || regexp_escape(lower(value)) || '(?:[^a-z0-9]|$)' AS pattern
  FROM normed, vals WHERE contains(norm, lower(value))),
kept AS (
  SELECT doc_id, attr, value FROM hits
  WHERE regexp_matches(norm, pattern)
    AND NOT regexp_matches(trim(regexp_replace(right(regexp_extract(norm, pattern, 1), 28), '[^a-z0-9]+', ' ', 'g')),
                           '(^| )({NEGATORS})$'))
SELECT doc_id, attr, arg_min(value, (-length(value), value)) AS value FROM kept GROUP BY doc_id, attr"""
ORACLES["batch_gate"] = cte(
    items(("Item",), 3), "SELECT hs_code, product, batch_no, pos, goods_shipped, complete, resolved FROM items"
)

# --- grouping and batches ----------------------------------------------------

LISTS = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {GOODS} ORDER BY ord) - 1 AS k FROM labelled),
lists AS (SELECT {GOODS}, k // 20 AS part, list(shipment_id ORDER BY k) AS ids FROM numbered GROUP BY ALL)"""
ORACLES["goods_to_shipments"] = cte(
    f"{ROWS}, {LISTS}", f"SELECT {GOODS}, part, array_to_string(ids, ',') AS shipment_ids FROM lists"
)
BATCHES = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY hs_code, product ORDER BY goods_shipped) - 1 AS k FROM goods)"""
ORACLES["batches"] = cte(
    f"{ROWS}, {BATCHES}",
    """SELECT hs_code, product, k // 10 AS batch_no, count(*) AS batch_size,
       CAST((SELECT ceil(count(*) / 10) FROM goods g WHERE g.hs_code = r.hs_code AND g.product = r.product) AS BIGINT)
         AS total_batches,
       string_agg(CAST(k % 10 + 1 AS VARCHAR) || '. ' || goods_shipped, chr(10) ORDER BY k) AS lines
       FROM ranked r GROUP BY hs_code, product, k // 10""",
)
LABEL_ITEMS = f"""{CLEAN},
seen AS (SELECT goods_shipped, min(ord) AS first_ord FROM clean GROUP BY goods_shipped),
seen_ranked AS (SELECT goods_shipped, row_number() OVER (ORDER BY first_ord, goods_shipped) - 1 AS k FROM seen),
label_items AS (SELECT goods_shipped, k // 10 AS batch_no, k % 10 AS pos FROM seen_ranked)"""
ORACLES["label_batches"] = cte(LABEL_ITEMS, "SELECT goods_shipped, batch_no, pos FROM label_items")
ORACLES["token_budget"] = cte(
    f"""{ROWS}, {BATCHES},
costs AS (SELECT hs_code, product, k // 10 AS batch_no,
                 CAST(floor(sum(length(goods_shipped)) / 4) + 3 * count(*) AS BIGINT) AS cost
          FROM ranked GROUP BY hs_code, product, k // 10),
spent AS (SELECT *, CAST(100 + coalesce(sum(cost) OVER (ORDER BY hs_code, product, batch_no
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS used_before FROM costs)""",
    "SELECT *, used_before < 2000 AS runs FROM spent",
)
ORACLES["goods_per_product_limit"] = cte(
    f"""{ROWS},
firsts AS (SELECT {GOODS}, min(ord) AS first_ord FROM labelled GROUP BY ALL),
places AS (SELECT *, row_number() OVER (PARTITION BY hs_code, product ORDER BY first_ord) AS place FROM firsts)""",
    f"SELECT {GOODS}, place FROM places WHERE place <= 7",
)

# --- label stage -------------------------------------------------------------

_CATEGORIES = "\n".join(f"- {c}: {d}" if d else f"- {c}" for c, d in V.DEFINITION)
_LABEL_PROMPT = (
    f"{_text(Q.LABEL_TASK + chr(10) + _CATEGORIES + chr(10) + 'Descriptions:' + chr(10))} || "
    f"string_agg(CAST(pos + 1 AS VARCHAR) || '. ' || goods_shipped, chr(10) ORDER BY pos) || chr(10) || "
    f"{_text(Q.LABEL_ANSWER)}"
)
_ENUM = ", ".join(f'"{c}"' for c, _ in V.DEFINITION)
_LABEL_SCHEMA = (
    '{"type": "object", "properties": {"classifications": {"type": "array", "items": '
    f'{{"type": "string", "enum": [{_ENUM}]}}}}}}, "required": ["classifications"]}}'
)
ORACLES["product_requests"] = cte(
    LABEL_ITEMS,
    f"""SELECT batch_no, count(*) AS batch_size,
       (SELECT count(DISTINCT batch_no) FROM label_items) AS total_batches, {_LABEL_PROMPT} AS prompt,
       {_text(_LABEL_SCHEMA)} AS reply_schema FROM label_items GROUP BY batch_no""",
)
ORACLES["token_cost"] = cte(
    LABEL_ITEMS,
    f"""SELECT batch_no, tokens, CAST(tokens + 3 * n AS BIGINT) AS cost FROM (
       SELECT batch_no, count(*) AS n, CAST(floor(length({_LABEL_PROMPT}) / 4) AS BIGINT) AS tokens
       FROM label_items GROUP BY batch_no)""",
)
_CHOICES = "([" + ", ".join(f"'{c}'" for c, _ in V.DEFINITION) + "])[(batch_no + pos) % 6 + 1]"
LABELLED = f"""{LABEL_ITEMS},
label_replied AS (
  SELECT goods_shipped, CASE batch_no % 7 WHEN 4 THEN 'Unclassified' WHEN 5 THEN 'Unclassified' WHEN 6 THEN ''
         WHEN 2 THEN CASE WHEN pos = max(pos) OVER (PARTITION BY batch_no) THEN '' ELSE {_CHOICES} END
         ELSE {_CHOICES} END AS category FROM label_items)"""
ORACLES["product_labels"] = cte(
    LABELLED,
    "SELECT c.ord, c.goods_shipped, r.category FROM clean c JOIN label_replied r USING (goods_shipped)",
)
ORACLES["strict_labels"] = cte(
    LABELLED,
    """SELECT CASE WHEN category = 'PROMO' THEN 'Unclassified' ELSE category END AS category, count(*) AS goods
       FROM label_replied GROUP BY 1""",
)
_WORDS = "list_distinct(regexp_extract_all(lower({}), '[\\p{{L}}\\p{{N}}]+'))"
ORACLES["lexical_labels"] = cte(
    f"""{CLEAN},
definition AS (SELECT place, category, {_WORDS.format("category || ' ' || coalesce(description, '')")} AS words
               FROM (VALUES {_values([(i, c, d) for i, (c, d) in enumerate(V.DEFINITION)])}) d(place, category, description)),
texts AS (SELECT goods_shipped, {_WORDS.format('goods_shipped')} AS words FROM (SELECT DISTINCT goods_shipped FROM clean)),
scores AS (SELECT goods_shipped, d.category, place, len(list_intersect(t.words, d.words)) AS shared
           FROM texts t, definition d),
best AS (SELECT goods_shipped, arg_max(category, (shared, -place)) AS category, max(shared) AS shared
         FROM scores GROUP BY goods_shipped)""",
    """SELECT ord, CASE WHEN shared > 0 THEN b.category ELSE 'Unclassified' END AS category
       FROM clean JOIN best b USING (goods_shipped)""",
)

# --- attribute requests and replies ------------------------------------------


def _guides(only, definitions: bool) -> str:
    meaning = ", ".join(f"({_text(k)}, {_text(d)})" for k, d in V.DEFINITIONS)
    return f"""shown AS (
  SELECT hs_code, product, attr, attr_ord, '- ' || attr || ': ' || string_agg(value, ', ' ORDER BY value_ord) AS preview,
         '"' || attr || '":{{"type":"string","enum":[' || string_agg('"' || value || '"', ',' ORDER BY value) ||
         ',"None"]}}' AS property FROM dict GROUP BY hs_code, product, attr, attr_ord),
explained AS (
  SELECT s.*, '- ' || attr || ': ' || coalesce(nullif(definition, ''), {_text(Q.NO_DEFINITION)}) AS definition
  FROM shown s LEFT JOIN (VALUES {meaning}) d(k, definition) ON k = 'attr_' || attr),
guides AS (
  SELECT hs_code, product, string_agg(definition, chr(10) ORDER BY attr_ord) AS definitions,
         string_agg(preview, chr(10) ORDER BY attr_ord) AS previews,
         string_agg(property, ',' ORDER BY attr_ord) AS properties FROM explained GROUP BY ALL)"""


ORACLES["attribute_requests"] = cte(
    f"""{items(size=25)}, {_guides(tuple(V.ATTRIBUTES), True)},
tables AS (SELECT hs_code, product, batch_no, count(*) AS batch_size,
                  string_agg(CAST(pos + 1 AS VARCHAR) || '. ' || goods_shipped, chr(10) ORDER BY pos) AS lines
           FROM items WHERE NOT resolved GROUP BY ALL),
counted AS (SELECT *, count(*) OVER (PARTITION BY hs_code, product) AS total_batches FROM tables),
prompts AS (
  SELECT hs_code, product, batch_no, batch_size, total_batches,
         concat_ws(chr(10), {_text(Q.ATTRIBUTE_TASK)}, 'Heading ' || hs_code || ' | Product ' || product || ' | Batch ' ||
           CAST(batch_no + 1 AS VARCHAR) || '/' || CAST(total_batches AS VARCHAR), 'Attributes:', definitions,
           'Allowed values:', previews, 'Descriptions:', lines, {_text(Q.ATTRIBUTE_ANSWER)}) AS prompt
  FROM counted JOIN guides USING (hs_code, product))""",
    "SELECT *, CAST(floor(length(prompt) / 4) AS BIGINT) AS tokens FROM prompts",
)
ORACLES["reply_schemas"] = cte(
    f"{items(('Color', 'Size'))}, {_guides(('Color', 'Size'), False)}",
    """SELECT DISTINCT hs_code, product, batch_no,
       '{"type":"object","properties":{"items":{"type":"array","items":{"type":"object","properties":'
       || '{"item_preview":{"type":"string"},"attributes":{"type":"object","properties":{' || properties
       || '},"required":[]}},"required":["item_preview","attributes"]}}},"required":["items"]}' AS reply_schema
       FROM items JOIN guides USING (hs_code, product) WHERE NOT resolved""",
)
ORACLES["parse_replies"] = cte(
    ALIGNED, "SELECT hs_code, product, batch_no, payload, doc IS NOT NULL AS readable FROM documents_read"
)
ORACLES["reply_alignment"] = cte(
    ALIGNED, "SELECT hs_code, product, batch_no, pos, goods_shipped, status, preview_ok FROM aligned"
)
_JUDGED = f"SELECT {GOODS}, status, attr, value, custom, out_of_schema, invalid FROM replied"
ORACLES["normalize_replies"] = cte(judged_replies(), _JUDGED)
ORACLES["normalize_replies_anchored"] = ORACLES["normalize_replies"]
ORACLES["normalize_replies_closed"] = cte(judged_replies(False), _JUDGED)
ORACLES["merge_values"] = cte(judged_replies(), f"SELECT {GOODS}, status, attr, value, custom FROM merged")
ORACLES["heuristic_fill"] = cte(judged_replies(), f"SELECT {GOODS}, status, attr, value, filled FROM filled")
ORACLES["validation_stats"] = cte(
    judged_replies(False),
    """SELECT count(*) FILTER (WHERE invalid) AS invalid, count(*) AS total_assignments,
       round(count(*) FILTER (WHERE invalid) / count(*), 6) AS invalid_ratio,
       count(*) FILTER (WHERE out_of_schema) AS out_of_schema, count(*) FILTER (WHERE filled) AS heuristic_fills
       FROM filled""",
)

# --- publication -------------------------------------------------------------

ORACLES["flat_attributes"] = cte(FLAT, "SELECT * FROM flat")
ORACLES["wide_per_product"] = cte(
    f"""{judged_replies()},
wide AS (SELECT {GOODS}, {_attribute_columns(flags=True)} FROM filled GROUP BY ALL)""",
    f"""SELECT shipment_id, w.*, {product_file('w.hs_code', 'w.product')} AS file
       FROM wide w JOIN labelled USING ({GOODS})""",
)
_ENTRY = "'\"' || attr || '\":\"' || value || '\"'"
ORACLES["nested_results"] = cte(
    f"""{judged_replies()}, {LISTS},
per_goods AS (
  SELECT {GOODS}, string_agg({_ENTRY}, ',' ORDER BY attr_ord) AS entries,
         string_agg('"' || attr || '"', ',' ORDER BY attr_ord) FILTER (WHERE custom) AS customs,
         string_agg('"' || attr || '"', ',' ORDER BY attr_ord) FILTER (WHERE filled) AS fills
  FROM filled GROUP BY ALL)""",
    f"""SELECT hs_code || '::' || product AS key, goods_shipped, part,
       '{{"goods_shipped":"' || goods_shipped || '","attributes":{{' || entries || '}}' ||
       coalesce(',"custom_attributes":[' || customs || ']', '') || coalesce(',"heuristic_filled":[' || fills || ']', '') ||
       ',"shipment_ids":["' || array_to_string(ids, '","') || '"]}}' AS record
       FROM per_goods JOIN lists USING ({GOODS})""",
)
ORACLES["completed_products"] = cte(
    ALIGNED,
    """SELECT hs_code || '::' || product AS key, count(*) AS completed FROM aligned WHERE status <> 'pending'
       GROUP BY hs_code, product""",
)
_SNAKE_ATTRS = [(a, a.lower(), i) for i, a in enumerate(V.ATTRIBUTES)]
ORACLES["schema_master"] = cte(
    f"""{FLAT},
named(attr, snake, attr_no) AS (VALUES {_values(_SNAKE_ATTRS)}),
spelled AS (
  SELECT hs_code, product, attr, value, min(ord) AS first_ord
  FROM labelled JOIN chosen USING ({GOODS}) GROUP BY hs_code, product, attr, value),
lists AS (SELECT hs_code, product, attr, string_agg('"' || value || '"', ',' ORDER BY first_ord, value) AS listed
          FROM spelled GROUP BY ALL),
files AS (SELECT DISTINCT hs_code, product FROM flat)""",
    """SELECT product, 'hs_' || hs_code || '_' || product || '.csv' AS file, CAST(0 AS BIGINT) AS part,
       '{' || string_agg('"' || snake || '":[' || coalesce(listed, '') || ']', ',' ORDER BY attr_no) || '}' AS schema_json
       FROM files JOIN attrs USING (hs_code, product) JOIN named USING (attr)
            LEFT JOIN lists USING (hs_code, product, attr) GROUP BY hs_code, product""",
)
ORACLES["folder_schema_master"] = ORACLES["schema_master"]
ORACLES["shipment_attributes"] = cte(
    f"""{FLAT},
named(attr, snake, attr_no) AS (VALUES {_values(_SNAKE_ATTRS)}),
placed AS (SELECT *, 'hs_' || hs_code || '_' || product || '.csv' AS file FROM labelled SEMI JOIN dict USING (hs_code, product)),
lasts AS (
  SELECT shipment_id, attr, arg_max(value, (file, ord)) AS value
  FROM placed JOIN chosen USING ({GOODS}) GROUP BY shipment_id, attr),
products AS (SELECT shipment_id, arg_max(product, (file, ord)) AS product FROM placed GROUP BY shipment_id)""",
    """SELECT shipment_id, product,
       '{' || coalesce(string_agg('"' || snake || '":"' || value || '"', ',' ORDER BY attr_no), '') || '}' AS attrs_json
       FROM products LEFT JOIN lasts USING (shipment_id) LEFT JOIN named USING (attr) GROUP BY shipment_id, product""",
)
ORACLES["run_shipment_map"] = cte(
    f"""{FLAT},
named(attr, snake, attr_no) AS (VALUES {_values(_SNAKE_ATTRS)}),
placed AS (SELECT *, 'hs_' || hs_code || '_' || product || '.csv' AS file,
                  min(CAST(shipment_id AS BIGINT) % 2) OVER (PARTITION BY {GOODS}) AS run
           FROM labelled SEMI JOIN dict USING (hs_code, product)),
lasts AS (
  SELECT shipment_id, attr, arg_max(value, (file, run, goods_shipped)) AS value
  FROM placed JOIN chosen USING ({GOODS}) GROUP BY shipment_id, attr),
products AS (SELECT shipment_id, arg_max(product, (file, run, goods_shipped)) AS product FROM placed GROUP BY shipment_id)""",
    """SELECT shipment_id, product,
       '{' || coalesce(string_agg('"' || snake || '":"' || value || '"', ',' ORDER BY attr_no), '') || '}' AS attrs_json
       FROM products LEFT JOIN lasts USING (shipment_id) LEFT JOIN named USING (attr) GROUP BY shipment_id, product""",
)
ORACLES["run_shipment_lists"] = cte(
    f"""{FLAT},
rows_in AS (SELECT *, CAST(shipment_id AS BIGINT) % 2 AS delivery FROM labelled SEMI JOIN dict USING (hs_code, product)),
told AS (SELECT *, min(delivery) OVER (PARTITION BY {GOODS}) AS known FROM rows_in),
pairs AS (
  SELECT {GOODS}, shipment_id, delivery, ord FROM told WHERE delivery = known
  UNION ALL
  SELECT {GOODS}, shipment_id, delivery, min(ord) FROM told WHERE delivery > known GROUP BY {GOODS}, shipment_id, delivery)""",
    """SELECT hs_code || '::' || product AS key, goods_shipped, CAST(0 AS BIGINT) AS part,
       string_agg(shipment_id, ',' ORDER BY delivery, ord) AS shipment_ids FROM pairs GROUP BY hs_code, product, goods_shipped""",
)
ORACLES["csv_round_trip"] = ORACLES["clean_shipments"]
ORACLES["conversation_attributes"] = f"""
WITH turns AS (SELECT CAST(conv_id AS VARCHAR) AS shipment_id, turn, role, text,
                      {strip('text')} AS reply FROM conversations)
SELECT shipment_id, arg_max(role, turn) AS product, arg_max(role, turn) AS last_role,
       arg_max(reply, turn) FILTER (WHERE turn % 2 = 1 AND lower(reply) NOT IN ('', 'nan', 'none', 'null')) AS last_reply,
       arg_max(CAST(length(text) AS VARCHAR), turn) FILTER (WHERE turn = 0) AS first_length
FROM turns GROUP BY shipment_id"""
ORACLES["run_metadata"] = cte(
    ALIGNED,
    """SELECT count(DISTINCT (hs_code, product)) AS products_processed,
       (SELECT string_agg(DISTINCT hs_code, ',' ORDER BY hs_code) FROM aligned WHERE status <> 'pending')
         AS hs_codes_processed,
       (SELECT CAST(sum(floor(length(reply) / 4)) AS BIGINT) FROM replies) AS token_usage,
       greatest(20000 - (SELECT CAST(sum(floor(length(reply) / 4)) AS BIGINT) FROM replies), 0) AS token_remaining,
       CAST(10 AS BIGINT) AS items_per_call FROM aligned WHERE status <> 'pending'""",
)

# --- inference ---------------------------------------------------------------


def samples(by: str, limit: int, name: str) -> str:
    return f"""{name} AS (
  SELECT grp, goods_shipped, CASE WHEN n > {limit} THEN drawn ELSE row_number() OVER (PARTITION BY grp ORDER BY first_ord) END
         AS place
  FROM (SELECT grp, goods_shipped, min(ord) AS first_ord, count(*) OVER (PARTITION BY grp) AS n,
               row_number() OVER (PARTITION BY grp ORDER BY md5('42|' || goods_shipped)) AS drawn
        FROM (SELECT {by} AS grp, goods_shipped, ord FROM clean) GROUP BY grp, goods_shipped)
  WHERE drawn <= {limit})"""


ORACLES["goods_sample"] = cte(
    f"{CLEAN}, {samples(digits('hs_code'), 120, 'a')}, {samples('category', 40, 'b')}",
    'SELECT grp AS "group", place, goods_shipped FROM a UNION ALL SELECT grp, place, goods_shipped FROM b',
)
_NUMBERED = "string_agg(CAST(place AS VARCHAR) || '. ' || goods_shipped, chr(10) ORDER BY place)"
ORACLES["inference_requests"] = cte(
    f"""{CLEAN.replace(SHIPMENTS, DETAILED)}, {SUMMARY}, {samples('category', 15, 's')},
texts AS (SELECT grp AS category, {_NUMBERED} AS g FROM s GROUP BY grp),
prompts AS (
  SELECT category, concat_ws(chr(10), '{Q.ATTRIBUTE_INFERENCE_TASK}' || category || ' of heading 0901', 'Descriptions:', g,
         'Columns:', {strip('summary')}) AS prompt FROM texts JOIN summaries USING (category))""",
    "SELECT category, prompt, CAST(floor(length(prompt) / 4) AS BIGINT) AS tokens FROM prompts",
)
ORACLES["product_inference_requests"] = cte(
    f"""{CLEAN}, {samples(digits('hs_code'), 25, 's')},
prompts AS (SELECT grp AS hs4, '{Q.PRODUCT_INFERENCE_TASK}' || grp || chr(10) || 'Descriptions:' || chr(10) || {_NUMBERED}
            AS prompt FROM s GROUP BY grp)""",
    "SELECT hs4, prompt, CAST(floor(length(prompt) / 4) AS BIGINT) AS tokens FROM prompts",
)
ORACLES["inferred_products"] = """
WITH listed AS (
  SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY p_type) AS pos, true AS whole
  FROM (SELECT DISTINCT p_brand, p_type FROM part)
  UNION ALL SELECT DISTINCT p_brand, 'ECONOMY', 99, false FROM part),
firsts AS (SELECT * FROM listed QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY pos) = 1)
SELECT p_brand AS hs_code, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY pos) - 1 AS INTEGER) AS ord,
       p_type AS category, CASE WHEN whole AND p_type <> 'SMALL' THEN 'Goods of type ' || p_type END AS description,
       CASE WHEN whole THEN 'a,b,c,d,' || p_type ELSE '' END AS representatives FROM firsts"""

# Columns that can stand in for attributes, as (attribute, column, definition).
_CANDIDATES = [f for f in I.FALLBACKS if f[1] in _SUMMARY_COLUMNS] + [
    ("Packaging_Type", "packaging_type", I.KEYWORD_DEFINITION.format("packaging_type")),
    ("Screen_Grade", "Screen-grade", I.KEYWORD_DEFINITION.format("Screen-grade")),
]
REPLIED = f"""nouns AS (SELECT DISTINCT p_type AS category, {initcap("regexp_extract(p_name, '[^ ]*$')")} AS v FROM part),
brands AS (SELECT DISTINCT p_type AS category, {initcap('p_brand')} AS v FROM part),
kinds AS (
  SELECT category, 'Item_Kind' AS attr, 0 AS attr_ord, 'Kind of item.' AS definition, string_agg(v, '|' ORDER BY lower(v)) AS vals,
         count(*) AS n, max(CASE WHEN v = 'Ring' THEN 1 ELSE 0 END) AS ring
  FROM nouns WHERE category NOT IN ('LARGE', 'PROMO') GROUP BY category),
replied_attrs AS (
  SELECT category, attr, attr_ord, definition, CASE WHEN ring = 1 THEN vals ELSE vals || '|Ring' END AS vals FROM kinds
  UNION ALL
  SELECT category, 'Brand_Name', 1, NULL, string_agg(v, '|' ORDER BY k) FROM (
    SELECT category, v, row_number() OVER (PARTITION BY category ORDER BY upper(v)) AS k FROM brands)
  WHERE category NOT IN ('LARGE', 'SMALL') GROUP BY category)"""
FALLBACK = f"""{_first_values([c for _, c, _ in _CANDIDATES], None)},
candidates(attr, "column", definition, try_order) AS (VALUES {_values([(a, c, d, i) for i, (a, c, d) in enumerate(_CANDIDATES)])}),
titled AS (SELECT category, "column", place, {initcap('value')} AS t FROM first_values),
once AS (SELECT category, "column", t, min(place) AS place FROM titled GROUP BY ALL),
observed AS (SELECT category, "column", string_agg(t, '|' ORDER BY place) AS vals FROM once GROUP BY ALL),
have AS (SELECT category, count(*) AS n FROM replied_attrs GROUP BY category),
tried AS (
  SELECT category, attr, definition, vals, try_order,
         row_number() OVER (PARTITION BY category ORDER BY try_order) AS nth FROM observed JOIN candidates USING ("column")),
fallback AS (SELECT t.* FROM tried t LEFT JOIN have USING (category) WHERE nth <= 3 - coalesce(n, 0))"""
ORACLES["fallback_attributes"] = cte(
    f"{DETAILED}, {REPLIED}, {FALLBACK}", 'SELECT category, attr, definition, vals AS "values" FROM fallback'
)
SCHEMA = f"""{DETAILED}, {REPLIED}, {FALLBACK},
both_kinds AS (
  SELECT category, attr, attr_ord AS place, definition, vals, 'reply' AS source FROM replied_attrs
  UNION ALL
  SELECT category, attr, CASE WHEN category = 'SMALL' AND attr = 'Transport_Method' THEN 2 ELSE 100 + try_order END,
         CASE WHEN category = 'SMALL' AND attr = 'Transport_Method' THEN 'How it travels.' ELSE definition END, vals,
         'fallback' FROM fallback),
schema_rows AS (
  SELECT category, attr, CAST(row_number() OVER (PARTITION BY category ORDER BY place) - 1 AS INTEGER) AS attr_ord, definition,
         vals, source FROM both_kinds)"""
ORACLES["inferred_schema"] = cte(
    SCHEMA, 'SELECT category, attr, attr_ord, definition, vals AS "values", source FROM schema_rows'
)
ORACLES["inferred_definitions"] = cte(
    SCHEMA,
    f"""SELECT 'attr_' || attr AS attr_key, arg_max(definition, place) AS definition
       FROM schema_rows JOIN (VALUES {_values([(i, c) for i, (c, _) in enumerate(V.DEFINITION)])}) c(place, category)
       USING (category) WHERE definition IS NOT NULL GROUP BY attr""",
)
ORACLES["inference_telemetry"] = cte(
    SCHEMA,
    """SELECT category, count(*) FILTER (WHERE source = 'reply') AS model_attribute_count,
       coalesce(string_agg(attr, ',' ORDER BY attr_ord) FILTER (WHERE source = 'fallback'), '') AS fallback_attributes,
       count(*) AS final_attribute_count FROM schema_rows GROUP BY category""",
)

# --- incremental runs --------------------------------------------------------

HALVES = f"""halves AS (
  SELECT '0001' AS hs_code, event_type AS product, 'value ' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS goods_shipped,
         CAST(user_id AS VARCHAR) AS shipment_id, ts < TIMESTAMP '2024-01-12' AS early FROM events),
old_rows AS (SELECT {GOODS}, shipment_id FROM halves WHERE early),
new_rows AS (SELECT {GOODS}, shipment_id FROM halves WHERE NOT early)"""
ORACLES["pending_goods"] = cte(
    HALVES, f"SELECT DISTINCT {GOODS} FROM new_rows ANTI JOIN old_rows USING ({GOODS})"
)
ORACLES["merge_shipments"] = cte(
    HALVES,
    f"""SELECT * FROM old_rows UNION ALL SELECT * FROM new_rows ANTI JOIN old_rows USING ({GOODS})
       UNION ALL SELECT * FROM (SELECT DISTINCT * FROM new_rows SEMI JOIN old_rows USING ({GOODS})
         EXCEPT SELECT * FROM old_rows)""",
)
