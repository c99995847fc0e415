"""DuckDB SQL for the registered queries, written on its own from the rules' definitions."""

from __future__ import annotations

from checks.relations import (
    ADDRESSES_CTE, CONTACTS_CTE, LARGE_ZIP_CTE, LINES_CTE, MEASURES_CTE, POSTAL_CTE, STREET_WORDS, ZIP_CTE,
)
from rowproof import lexicon


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values_cte(name: str, rows: dict[str, str]) -> str:
    body = ", ".join(f"({q(a)}, {q(b)})" for a, b in rows.items())
    return f"{name}(code, name) AS (VALUES {body})"


COUNTRIES_CTE = values_cte("countries", lexicon.countries())
US_CTE = values_cte("us_states", lexicon.US_STATES)
CA_CTE = values_cte("ca_states", lexicon.CA_PROVINCES)
GEO = f"{COUNTRIES_CTE}, {US_CTE}, {CA_CTE}"
CODES = "(" + ", ".join(q(c) for c in lexicon.countries()) + ")"
US_CODES = "(" + ", ".join(q(c) for c in lexicon.US_STATES) + ")"
CA_CODES = "(" + ", ".join(q(c) for c in lexicon.CA_PROVINCES) + ")"


def country_code(c: str) -> str:
    by_name = f"(SELECT code FROM countries k WHERE k.name = upper({c}))"
    return f"CASE WHEN {c} IN {CODES} THEN {c} ELSE {by_name} END"


def state_ok(s: str, c: str) -> str:
    return f"""CASE {c} WHEN 'US' THEN coalesce({s} IN {US_CODES}, false)
        WHEN 'CA' THEN coalesce({s} IN {CA_CODES}, false) ELSE true END"""


def state_code(s: str, c: str) -> str:
    return f"""CASE {c} WHEN 'US' THEN (SELECT code FROM us_states k WHERE upper(k.name) = upper(trim({s})))
        WHEN 'CA' THEN (SELECT code FROM ca_states k WHERE upper(k.name) = upper(trim({s}))) END"""


def state_country(s: str) -> str:
    return f"CASE WHEN {s} IN {US_CODES} THEN 'US' WHEN {s} IN {CA_CODES} THEN 'CA' END"


def title(s: str) -> str:
    pieces = f"regexp_extract_all({s}, '[A-Za-z]+(?:''[A-Za-z]+)?|[^A-Za-z]+')"
    word = "CASE WHEN regexp_matches(p, '^[A-Za-z]') THEN upper(p[1]) || lower(p[2:]) ELSE p END"
    return (
        f"CASE WHEN {s} IS NOT NULL THEN "
        f"array_to_string(list_transform({pieces}, lambda p: {word}), '') END"
    )


def letters(s: str) -> str:
    bare = f"regexp_replace(trim({s}), '[''\\- \\t]', '', 'g')"
    return f"coalesce(regexp_matches({bare}, '^\\p{{L}}+$'), false)"


def scrub(s: str) -> str:
    spaced = f"regexp_replace({s}, '[\\r\\n\\t\\f]', ' ', 'g')"
    return f"regexp_replace({spaced}, '[^\\x20-\\x7E]+', '', 'g')"


def zip_fits(p: str, c: str) -> str:
    return f"""coalesce(CASE {c} WHEN 'US' THEN regexp_matches({p}, '^\\d{{5}}(-\\d{{4}})?$')
        WHEN 'AU' THEN regexp_matches({p}, '^\\d{{4}}')
        WHEN 'BR' THEN regexp_matches({p}, '^\\d{{5}}-?\\d{{3}}')
        WHEN 'DE' THEN regexp_matches({p}, '^\\d{{5}}')
        WHEN 'CA' THEN regexp_matches({p}, '^[A-Z]\\d[A-Z] \\d[A-Z]\\d$')
        WHEN 'FR' THEN regexp_matches({p}, '^\\d{{5}}$')
        WHEN 'JP' THEN regexp_matches({p}, '^\\d{{3}}-\\d{{4}}$')
        WHEN 'GB' THEN regexp_matches({p}, '^[A-Z]{{1,2}}\\d[A-Z\\d]? \\d[A-Z]{{2}}$')
        WHEN 'IN' THEN regexp_matches({p}, '^[1-9]\\d{{2}}\\s?\\d{{3}}$') END, false)"""


# ---- frequency, describe, statistics ---------------------------------------------------------


def long_counts(source: str, columns: dict[str, str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {q(name)} AS c, CAST({text} AS VARCHAR) AS v FROM {source}"
        for name, text in columns.items()
    )
    return f"""counts AS (SELECT c, v, count(*) AS n FROM ({parts}) GROUP BY c, v),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v ASC NULLS LAST) AS r,
            CAST(sum(n) OVER (PARTITION BY c) AS DOUBLE) AS total FROM counts)"""


def freq(source: str, columns: list[str] | dict[str, str], name: str, ctes: str = "",
         where: str = "") -> str:
    named = columns if isinstance(columns, dict) else {c: c for c in columns}
    return f"""WITH {ctes}{long_counts(source, named)}
        SELECT v AS table_values, CAST(n AS BIGINT) AS value_counts, n / total AS value_percent,
            c AS table_column, {q(name)} AS table_name FROM ranked WHERE r <= 50 {where}"""


def freq_text(source: str, columns: list[str]) -> str:
    return f"""WITH {long_counts(source, {c: c for c in columns})}
        SELECT lower(c) AS column_name, CAST(r AS INTEGER) AS rank, v AS categories,
            CAST(n AS BIGINT) AS counts,
            CAST(round_even(n / total * 100 * 100, 0) / 100 AS VARCHAR) || '%' AS percent
        FROM ranked WHERE r <= 50"""


def number_row(source: str, c: str, expr: str | None = None) -> dict[str, str]:
    x = f"CAST({expr or c} AS DOUBLE)"
    return {
        "counts": f"count({c})", "mean": f"avg({x})", "min_value": f"min({x})",
        "first_iq": f"quantile_cont({x}, 0.25)", "middle_iq": f"quantile_cont({x}, 0.5)",
        "third_iq": f"quantile_cont({x}, 0.75)", "max_value": f"max({x})",
        "std": f"stddev_samp({x})",
    }


def describe_row(source: str, c: str, kind: str, digits: int, expr: str | None = None) -> str:
    numeric = kind not in ("string",)
    f = number_row(source, c, expr)
    if numeric:
        spread = ", ".join(
            f"round({f[k]}, {digits}) AS {k}"
            for k in ("mean", "min_value", "first_iq", "middle_iq", "third_iq", "max_value", "std")
        )
        labels = "CAST(NULL AS BIGINT) AS unique_values, CAST(NULL AS VARCHAR) AS top_values, CAST(NULL AS BIGINT) AS freq"
    else:
        spread = ", ".join(
            f"CAST(NULL AS DOUBLE) AS {k}"
            for k in ("mean", "min_value", "first_iq", "middle_iq", "third_iq", "max_value", "std")
        )
        top = f"""(SELECT {{pick}} FROM (SELECT {c} AS v, count(*) AS n FROM {source}
            WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, v LIMIT 1))"""
        labels = (
            f"CAST(count(DISTINCT {c}) AS BIGINT) AS unique_values, "
            f"{top.format(pick='v')} AS top_values, CAST({top.format(pick='n')} AS BIGINT) AS freq"
        )
    return f"""SELECT {q(source)} AS table_name, {q(c)} AS column_name, {q(kind)} AS data_types,
        CAST(count({c}) AS BIGINT) AS counts, {labels}, {spread},
        CAST(count(*) - count({c}) AS BIGINT) AS nulls, CAST(count(*) AS BIGINT) AS total_rows
        FROM {source}"""


def describe_all(source: str, columns: dict[str, str], digits: int) -> str:
    rows = []
    for c, kind in columns.items():
        expr = f"epoch_us({c}) / 1e6" if kind.startswith("timestamp") else None
        rows.append(describe_row(source, c, kind, digits, expr))
    return " UNION ALL ".join(rows)


def quartile_fields(x: str, digits: int = 4) -> str:
    q1, q3 = f"quantile_cont({x}, 0.25)", f"quantile_cont({x}, 0.75)"
    return f"""round({q1}, {digits}) AS first_quartile, round({q3}, {digits}) AS third_quartile,
        round({q3} - {q1}, {digits}) AS interquartile_range,
        round({q3} + ({q3} - {q1}) * 1.5, {digits}) AS iq_upper,
        round({q1} - ({q3} - {q1}) * 1.5, {digits}) AS iq_lower"""


def numeric_stats() -> str:
    rows = []
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"):
        x = f"CAST({c} AS DOUBLE)"
        rows.append(
            f"""SELECT {q(c)} AS column_name, round(avg({x}), 4) AS mean,
            round(quantile_cont({x}, 0.5), 4) AS median, round(stddev_samp({x}), 4) AS std,
            round(var_samp({x}), 1) AS variance, {quartile_fields(x)},
            round(avg({x}) + 3 * stddev_samp({x}), 4) AS upper,
            round(avg({x}) - 3 * stddev_samp({x}), 4) AS lower FROM lineitem"""
        )
    return " UNION ALL ".join(rows)


def profile_row(c: str, kind: str) -> str:
    texts = ("string",)
    numeric = kind not in texts
    x = f"CAST({c} AS DOUBLE)"
    none = "CAST(NULL AS DOUBLE)"
    num = {
        "min": f"min({x})", "mean": f"avg({x})", "max": f"max({x})", "std": f"stddev_samp({x})",
        "p05": f"quantile_cont({x}, 0.05)", "p25": f"quantile_cont({x}, 0.25)",
        "p50": f"quantile_cont({x}, 0.5)", "p75": f"quantile_cont({x}, 0.75)",
        "p95": f"quantile_cont({x}, 0.95)",
    }
    spread = ", ".join(
        f"round({v}, 4) AS {k}" if numeric else f"{none} AS {k}" for k, v in num.items()
    )
    zero = f"CAST(count(*) FILTER ({c} = 0) AS BIGINT)" if numeric else "CAST(NULL AS BIGINT)"
    negative = f"CAST(count(*) FILTER ({c} < 0) AS BIGINT)" if numeric else "CAST(NULL AS BIGINT)"
    size = (
        f"""CAST(min(length({c})) AS BIGINT) AS min_length, round(avg(length({c})), 4) AS mean_length,
        CAST(max(length({c})) AS BIGINT) AS max_length"""
        if not numeric
        else "CAST(NULL AS BIGINT) AS min_length, CAST(NULL AS DOUBLE) AS mean_length, CAST(NULL AS BIGINT) AS max_length"
    )
    return f"""SELECT {q(c)} AS column_name, {q(kind)} AS data_type, CAST(count(*) AS BIGINT) AS n,
        CAST(count(*) - count({c}) AS BIGINT) AS n_missing,
        round((count(*) - count({c})) / count(*), 4) AS p_missing,
        CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct,
        round(count(DISTINCT {c}) / count({c}), 4) AS p_distinct,
        count(DISTINCT {c}) = count({c}) AND count({c}) > 0 AS is_unique,
        {zero} AS n_zeros, {negative} AS n_negative, {spread}, {size} FROM customer"""


def histogram() -> str:
    rows = []
    for c in ("l_quantity", "l_extendedprice"):
        rows.append(
            f"""SELECT {q(c)} AS column_name, bin, round(lo + (hi - lo) / 50 * bin, 4) AS lower,
            round(lo + (hi - lo) / 50 * (bin + 1), 4) AS upper, CAST(count(*) AS BIGINT) AS n
            FROM (SELECT CAST(least(floor(({c} - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin, lo, hi
                FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem))
            GROUP BY bin, lo, hi"""
        )
    return " UNION ALL ".join(rows)


def describe_report(source: str, columns: dict[str, str]) -> str:
    """One row per column and statistic of the transposed report."""
    rows = []
    for c, kind in columns.items():
        x, numeric = f"CAST({c} AS DOUBLE)", kind != "string"
        numbers = {
            "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})", "25%": f"quantile_cont({x}, 0.25)",
            "50%": f"quantile_cont({x}, 0.5)", "75%": f"quantile_cont({x}, 0.75)", "max": f"max({x})",
        }
        top = f"(SELECT {{pick}} FROM (SELECT {c} AS v, count(*) AS n FROM {source} GROUP BY 1 ORDER BY n DESC, v LIMIT 1))"
        texts = {
            "count": f"CAST(count({c}) AS VARCHAR)", "data_types": f"max({q(kind)})",
            "null_counts": f"CAST(count(*) - count({c}) AS VARCHAR)", "total_rows": "CAST(count(*) AS VARCHAR)",
            "unique": "max(NULL::VARCHAR)" if numeric else f"CAST(count(DISTINCT {c}) AS VARCHAR)",
            "top": "max(NULL::VARCHAR)" if numeric else f"max({top.format(pick='v')})",
            "freq": "max(NULL::VARCHAR)" if numeric else f"CAST(max({top.format(pick='n')}) AS VARCHAR)",
        }
        rows += [
            f"""SELECT {q(label)} AS categories, {q(c)} AS column_name,
            {f'round({value}, 3)' if numeric else 'max(CAST(NULL AS DOUBLE))'} AS number, CAST(NULL AS VARCHAR) AS text FROM {source}"""
            for label, value in numbers.items()
        ]
        rows += [
            f"""SELECT {q(label)}, {q(c)}, CAST(NULL AS DOUBLE), {value} FROM {source}"""
            for label, value in texts.items()
        ]
    return " UNION ALL ".join(rows)


# ---- missing values --------------------------------------------------------------------------

# The same rows with NaN as null, for which every other rule holds.
CLEAN_MEASURES = f"""{MEASURES_CTE}, clean AS (SELECT id, CASE WHEN NOT isnan(few) THEN few END AS few,
    CASE WHEN NOT isnan(many) THEN many END AS many, CASE WHEN NOT isnan(endless) THEN endless END AS endless
    FROM measures)"""


def nan_statistics() -> str:
    rows = [
        f"""SELECT {q(c)} AS column_name, round(avg({c}), 4) AS mean, round(quantile_cont({c}, 0.5), 4) AS median,
        round(stddev_samp({c}), 4) AS std, round(var_samp({c}), 1) AS variance, {quartile_fields(c)},
        round(avg({c}) + 3 * stddev_samp({c}), 4) AS upper, round(avg({c}) - 3 * stddev_samp({c}), 4) AS lower FROM clean"""
        for c in ("few", "many")
    ]
    none = ", ".join(f"NULL AS {x}" for x in ("mean", "median", "std", "variance"))
    rows.append(f"SELECT 'endless' AS column_name, {none}, {quartile_fields('endless')}, NULL AS upper, NULL AS lower FROM clean")
    return f"WITH {CLEAN_MEASURES} " + " UNION ALL ".join(rows)


def fenced(c: str) -> str:
    return f"coalesce({c} < {c}1 - ({c}3 - {c}1) * 1.5 OR {c} > {c}3 + ({c}3 - {c}1) * 1.5, false)"


NAN_FLAGS = f"""WITH {CLEAN_MEASURES}, s AS (SELECT
    avg(coalesce(few, 0)) AS fm, stddev_pop(coalesce(few, 0)) AS fs,
    avg(coalesce(many, 0)) AS mm, stddev_pop(coalesce(many, 0)) AS ms,
    {', '.join(f'quantile_cont({c}, 0.{n}) AS {c}{k}' for c in ('few', 'many', 'endless') for n, k in ((25, 1), (75, 3)))}
    FROM clean)"""

NAN_PROFILE = f"WITH {CLEAN_MEASURES} " + " UNION ALL ".join(
    profile_row(c, "double").replace("FROM customer", "FROM clean") for c in ("few", "many")
)


# ---- contacts: phone, e-mail, web, names, verdict --------------------------------------------

TAIL = "(?i)\\s*[,;]?\\s*(ext|ext\\.|extension|x|#)\\s*\\d+\\s*$"
PLUS_NOT_ONE = "regexp_matches(replace(phone, ' ', ''), '^\\+([^1]|$)')"


def clean_phone(p: str) -> str:
    return f"trim(regexp_replace(regexp_replace({p}, '^\\+?1?', ''), '[ ()-]', '', 'g'))"


def phone_formatted(p: str) -> str:
    t = clean_phone(p)
    return f"""CASE WHEN length({t}) >= 10 THEN '(' || substr({t}, 1, 3) || ') ' || substr({t}, 4, 3)
        || '-' || substr({t}, 7, 4) END"""


def phone_ext(p: str) -> str:
    t = clean_phone(p)
    return f"CASE WHEN length({t}) > 10 THEN 'Ext ' || regexp_replace(substr({t}, 11), '\\D', '', 'g') END"


def phone_ok(p: str) -> str:
    number = f"regexp_replace({p}, {q(TAIL)}, '')"
    digits = f"regexp_replace({number}, '\\D', '', 'g')"
    return f"""(regexp_matches({number}, '^[0-9 ()+./-]+$')
        AND regexp_matches({digits}, '^1?[2-9]\\d{{2}}[2-9]\\d{{6}}$'))"""


def email_ok(e: str) -> str:
    pattern = "^\\b[A-Za-z0-9._%'+-]+@[A-Za-z0-9.-]+[.][A-Za-z|]{2,20}\\b$"
    return f"coalesce(regexp_matches({e}, {q(pattern)}), false)"


def email_normal(e: str) -> str:
    atom, label = "[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+", "[A-Za-z0-9]([A-Za-z0-9-]{0,61}[A-Za-z0-9])?"
    pattern = f"^{atom}([.]{atom})*@({label}[.])+([A-Za-z0-9][A-Za-z0-9-]{{0,61}})?[A-Za-z]$"
    return f"""CASE WHEN regexp_matches({e}, {q(pattern)}) AND strpos({e}, '@') <= 65
        AND length({e}) <= 254
        THEN split_part({e}, '@', 1) || '@' || lower(split_part({e}, '@', 2)) END"""


def url_ok(u: str) -> str:
    host = f"regexp_extract({u}, '://([^/?#]*)', 1)"
    return f"""coalesce(regexp_matches({u}, '^[\\x00-\\x20]*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]')
        AND contains({host}, '[') = contains({host}, ']'), false)"""


PHONE_RESULT = f"""us AS (SELECT *, coalesce({country_code('country')} = 'US', false) AS is_us FROM src),
    shaped AS (SELECT *, CASE WHEN is_us THEN {phone_formatted('phone')} END AS shape FROM us),
    checked AS (SELECT *, is_us AND coalesce({phone_ok('shape')}, false)
        AND NOT coalesce({PLUS_NOT_ONE}, false) AS valid FROM shaped),
    phoned AS (SELECT *, coalesce(shape, phone) AS formatted,
        CASE WHEN valid THEN {phone_ext('phone')} END AS ext FROM checked)"""

CHECKED_CONTACTS = f"""WITH {COUNTRIES_CTE}, {CONTACTS_CTE}, src AS (SELECT * FROM contacts),
    {PHONE_RESULT},
    stats AS (SELECT avg(coalesce(revenue, 0)) AS mean, stddev_pop(coalesce(revenue, 0)) AS std,
        quantile_cont(revenue, 0.25) AS q1, quantile_cont(revenue, 0.75) AS q3 FROM contacts),
    ruled AS (SELECT contact_id, account_id, first_name, last_name, email, phone, url, country, revenue,
        valid AS phone_is_valid, formatted AS phone_formatted, ext AS phone_ext_formatted,
        {email_normal('email')} AS email_normalized, {email_ok('email')} AS email_check,
        {url_ok('url')} AS url_is_valid, {letters('first_name')} AS first_name_check,
        abs((coalesce(revenue, 0) - mean) / std) > 3 AS "revenue_isOutlier",
        coalesce(revenue < q1 - (q3 - q1) * 1.5 OR revenue > q3 + (q3 - q1) * 1.5, false)
            AS revenue_iq_outlier
        FROM phoned, stats),
    flagged AS (SELECT *, phone_is_valid AND email_check AND first_name_check
        AND NOT "revenue_isOutlier" AND NOT revenue_iq_outlier AS row_is_valid FROM ruled)"""


def contact_detail(*columns: str) -> str:
    shown = ", ".join(("contact_id", "account_id", "row_is_valid", *columns))
    return f"{CHECKED_CONTACTS} SELECT {shown} FROM flagged"


CHECKS = [
    "phone_is_valid", "email_check", "url_is_valid", "first_name_check", "revenue_isOutlier",
    "revenue_iq_outlier",
]


def contact_freq(columns: list[str]) -> str:
    named = {c: f'"{c}"' for c in columns}
    head = CHECKED_CONTACTS.removeprefix("WITH ") + ", "
    return freq("flagged", named, "contacts", head)


def dups(source: str, key: str, columns: dict[str, str], name: str, ctes: str = "") -> str:
    rows = " UNION ALL ".join(
        f"""SELECT CAST({key} AS VARCHAR) AS table_primary_key, CAST({text} AS VARCHAR) AS field_value,
        {q(label)} AS table_column FROM {source}"""
        for label, text in columns.items()
    )
    return f"""{f'WITH {ctes}' if ctes else ''}
        SELECT table_primary_key, field_value, table_column, {q(name)} AS table_name FROM (
            SELECT *, count(*) OVER (PARTITION BY table_column, field_value) AS n FROM ({rows})
            WHERE field_value IS NOT NULL) WHERE n > 1"""


# ---- addresses -------------------------------------------------------------------------------

PART_NAMES = "['street_number', 'street_name', 'street_type', 'unit', 'city', 'region1', 'postal_code']"


PO_BOX = "[pP][.]?[ ]?[oO][.]?[ ][bB][oO][xX][ ]\\d+"
UNITS = ["apartment", "apt", "building", "bldg", "department", "dept", "floor", "fl", "lobby", "lbby", "lot", "suite", "ste", "unit"]
STREETS = [w.lower() for w in STREET_WORDS]


def any_of(words: list[str]) -> str:
    """Plain alternatives, longer ones first."""
    longest = sorted({w.lower() for w in words}, key=lambda w: (-len(w), w))
    return "(?:" + "|".join(w.replace(".", "[.]").replace(" ", "\\s+") for w in longest) + ")"


def one_address(regions: list[str], postal: str) -> str:
    way = any_of(["north", "south", "east", "west", "northeast", "northwest", "southeast", "southwest",
                  "ne", "nw", "se", "sw", "n", "s", "e", "w"])
    gap = "(?:\\s*,\\s*|\\s+)"
    return (
        f"(?is)\\b(\\d{{1,6}})\\s+((?:[a-z0-9'.]+\\s+){{0,3}}?[a-z0-9'.]+)\\s+({any_of(STREETS)})\\b[.]?"
        f"(?:\\s+{way}\\b[.]?)?{gap}(?:({any_of(UNITS)}\\b[.]?\\s+[a-z0-9-]+){gap})?"
        f"([a-z][a-z .'-]*?){gap}({any_of(regions)}){gap}({postal})\\b"
    )


def parse(text: str, code: str) -> str:
    us = q(one_address([*lexicon.US_STATES, *lexicon.US_STATES.values(), "Guam GU", "Puerto Rico PR"], "\\d{5}(?:-\\d{4})?"))
    ca = q(one_address([*lexicon.CA_PROVINCES, *lexicon.CA_PROVINCES.values()], "[a-z]\\d[a-z]\\s?\\d[a-z]\\d"))
    return f"""CASE {code} WHEN 'US' THEN regexp_extract({text}, {us}, {PART_NAMES})
        WHEN 'CA' THEN regexp_extract({text}, {ca}, {PART_NAMES}) END"""


FULL_TEXT = """concat_ws(' ', address1, address2, city) || ', '
    || concat_ws(' ', state, postal_code, country)"""
NO_SECOND = """concat_ws(' ', address1, city) || ', ' || concat_ws(' ', state, postal_code, 'US')"""


def word_list(words: list[str]) -> str:
    return "[" + ", ".join(q(w) for w in words) + "]"


def words_in(text: str, words: list[str]) -> str:
    bare = f"lower(trim(regexp_replace({text}, '[^A-Za-z ''\\-]+', '', 'g')))"
    return f"""len(list_filter(regexp_split_to_array({bare}, '\\s+'),
        lambda w: list_contains({word_list(words)}, w)))"""


def cleaned_addresses(prefix: str, a2: str, country: str, text: str) -> str:
    """CTEs that end in `{prefix}_done`, one row per address."""
    p = prefix
    return f"""{p}_a AS (SELECT address_id, address1 AS a1, {a2} AS a2, city AS city0, state AS state0,
        postal_code AS zip0, {country} AS country0, {text} AS full_text,
        {country_code(country)} AS code0 FROM addresses),
    {p}_b AS (SELECT *, coalesce(regexp_matches(a1, {q(PO_BOX)}), false) AS po1,
        coalesce(regexp_matches(a2, {q(PO_BOX)}), false) AS po2,
        coalesce(contains(lower(a1), 'suite') OR contains(lower(a1), 'ste'), false) AS suite_word,
        {parse('full_text', 'code0')} AS x FROM {p}_a),
    {p}_c AS (SELECT *, coalesce(x.street_number <> '', false) AS ok,
        CASE WHEN po1 THEN 'PO Box ' || regexp_extract(lower(replace(a1, ' ', '')), 'box(.*)$', 1)
            ELSE a1 END AS line1 FROM {p}_b),
    {p}_d AS (SELECT *, coalesce(contains(line1, '#'), false) AS has_hash,
        coalesce(contains(line1, ','), false) AS has_comma FROM {p}_c),
    {p}_e AS (SELECT *,
        CASE WHEN ok THEN x.street_number || ' ' || trim(x.street_name) || ' ' || x.street_type
            WHEN has_hash THEN trim(split_part(line1, '#', 1))
            WHEN has_comma THEN trim(split_part(line1, ',', 1)) ELSE line1 END AS street,
        CASE WHEN ok THEN nullif(trim(x.unit), '')
            WHEN has_hash THEN concat_ws(' ', a2, substr(line1, strpos(line1, '#')))
            WHEN has_comma THEN concat_ws(' ', '#' || substr(line1, strpos(line1, ',') + 1), a2)
            ELSE a2 END AS suite,
        CASE WHEN ok THEN trim(x.city) ELSE city0 END AS city,
        CASE WHEN ok THEN x.region1 ELSE state0 END AS state,
        CASE WHEN ok THEN x.postal_code ELSE zip0 END AS postal FROM {p}_d),
    {p}_f AS (SELECT e.*, z.zip IS NOT NULL AS hit, z.place, z.state AS zip_state,
        coalesce(country0 IN {CODES}, false) AS is_code,
        CASE WHEN country0 IN {CODES} THEN country0
            WHEN country0 IS NOT NULL THEN {country_code('country0')}
            ELSE {state_country('e.state')} END AS country1
        FROM {p}_e e LEFT JOIN zip_ref z ON substr(e.postal, 1, 5) = z.zip),
    {p}_g AS (SELECT *, CASE WHEN country1 = 'US' THEN hit ELSE {zip_fits('postal', 'country1')} END
        AS zip_ok FROM {p}_f),
    {p}_h AS (SELECT *, CASE WHEN state IS NULL AND zip_ok AND zip0 IS NOT NULL THEN zip_state
        ELSE state END AS state1, CASE WHEN zip_ok THEN place END AS zip_city FROM {p}_g),
    {p}_i AS (SELECT *, country1 IS NOT NULL AND NOT ({state_ok('state1', 'country1')}) AS bad_state,
        {state_code('state1', 'country1')} AS named_state, {letters('city')} AS alpha FROM {p}_h),
    {p}_j AS (SELECT *, bad_state AND named_state IS NULL AS lost,
        CASE WHEN bad_state AND named_state IS NOT NULL THEN named_state ELSE state1 END AS state2,
        CASE WHEN bad_state AND named_state IS NULL THEN NULL ELSE country1 END AS country2
        FROM {p}_i),
    {p}_k AS (SELECT *, city IS NULL AND zip_city IS NOT NULL AS filled,
        city IS NOT NULL AND alpha AND state2 IS NOT NULL AND postal IS NOT NULL
            AND zip_city IS NOT NULL AND lower(zip_city) <> lower(city) AS respelled FROM {p}_j),
    {p}_l AS (SELECT *, CASE WHEN filled OR respelled THEN zip_city ELSE city END AS city1 FROM {p}_k),
    {p}_m AS (SELECT *, CASE WHEN length(city1) > 3 THEN trim({title('city1')}) ELSE city1 END AS city2
        FROM {p}_l),
    {p}_n AS (SELECT *, CASE WHEN ok THEN
        CASE WHEN suite IS NOT NULL THEN coalesce(street, '') || ' ' || suite
            ELSE coalesce(line1, '') END || ' ' || coalesce(city2, '') || ', ' || coalesce(state2, '')
            || ' ' || coalesce(postal, '') || ' ' || coalesce(country0, '') END AS again FROM {p}_m),
    {p}_o AS (SELECT *, coalesce(({parse('again', 'country2')}).street_number <> '', false) AS parses
        FROM {p}_n),
    {p}_done AS (SELECT *, array_to_string(list_filter([
        CASE WHEN street IS NULL THEN 'Missing address' END,
        CASE WHEN street IS NULL OR {words_in('street', STREETS)} > 2
            OR {words_in('street', UNITS)} >= 1 THEN 'possible parsing issue' END,
        CASE WHEN country0 IS NULL THEN 'Missing Country' END,
        CASE WHEN country0 IS NOT NULL AND NOT is_code AND country1 IS NOT NULL
            THEN 'Country Reformatted to Code' END,
        CASE WHEN country0 IS NOT NULL AND country1 IS NULL THEN 'Invalid Country' END,
        CASE WHEN country0 IS NULL AND country1 IS NOT NULL THEN 'Country Reformatted by State' END,
        CASE WHEN postal IS NULL OR NOT zip_ok THEN 'Bad Postal Code' END,
        CASE WHEN state IS NULL AND zip0 IS NULL THEN 'Missing State / Zip' END,
        CASE WHEN state IS NULL AND zip0 IS NOT NULL THEN 'Reformatting State Using Zip' END,
        CASE WHEN bad_state AND NOT lost THEN 'State Reformatted' END,
        CASE WHEN lost THEN 'Invalid State' END,
        CASE WHEN city IS NULL AND zip0 IS NULL THEN 'Missing City' END,
        CASE WHEN city IS NOT NULL AND NOT alpha THEN 'City is not alpha' END,
        CASE WHEN filled THEN 'Reformatted City with Zip' END,
        CASE WHEN respelled THEN 'City spelling reformatted' END,
        CASE WHEN parses THEN NULL WHEN suite_word AND a2 IS NOT NULL THEN 'Check if suite is valid'
            WHEN NOT po1 AND NOT po2 AND NOT has_hash THEN 'Not capable of parsing'
            WHEN po1 THEN 'PO Box reformat' WHEN po2 THEN 'Check PO Box in Suite'
            ELSE 'Building number reformat' END], lambda m: m IS NOT NULL), ',') AS messages,
        lower(trim(regexp_replace(street || ' ' || city2 || ' ' || state2 || ' '
            || substr(postal, 1, 5), '[^A-Za-z0-9 ]+', '', 'g'))) AS match_key FROM {p}_o)"""


ADDRESS_BASE = f"{GEO}, {ZIP_CTE}, {ADDRESSES_CTE}"
MAIN = cleaned_addresses("main", "address2", "country", FULL_TEXT)
BACKUP = cleaned_addresses("backup", "CAST(NULL AS VARCHAR)", "'US'", NO_SECOND)
BOTH = f"""{ADDRESS_BASE}, {MAIN}, {BACKUP},
    joined AS (SELECT m.address_id, {', '.join(
        f"{t}.messages = '' AS {p}_addr_is_valid, {t}.messages AS {p}_addr_error_messg, {t}.street AS {p}_street, "
        f"{t}.suite AS {p}_suite, {t}.city2 AS {p}_city, {t}.state2 AS {p}_state, {t}.postal AS {p}_postal_code, "
        f"{t}.country2 AS {p}_country, {t}.match_key AS {p}_full_address"
        for p, t in (('main', 'm'), ('backup', 'b')))}
        FROM main_done m JOIN backup_done b USING (address_id))"""
PARSED = """x.street_number AS street_number, trim(x.street_name) AS street_name,
            x.street_type AS street_type,
            CASE WHEN NOT regexp_matches(x.unit, '(?i)^(building|bldg)\\b') THEN nullif(x.unit, '') END
                AS occupancy,
            CASE WHEN regexp_matches(x.unit, '(?i)^(building|bldg)\\b') THEN x.unit END AS building_id,
            x.city AS city, x.region1 AS region1, x.postal_code AS postal_code,
            CASE WHEN x IS NOT NULL THEN cc END AS country_id"""


# ---- fuzzy matching --------------------------------------------------------------------------


def lcs(a: str, b: str) -> str:
    """Longest common subsequence by bit masks over `a`, one step per character of `b`."""
    masks = f"""list_transform(string_split({b}, ''), lambda ch: CAST(list_sum(list_transform(
        range(1, length({a}) + 1), lambda i: CASE WHEN {a}[i] = ch THEN CAST(1 AS HUGEINT) << (i - 1)
        ELSE CAST(0 AS HUGEINT) END)) AS HUGEINT))"""
    full = f"((CAST(1 AS HUGEINT) << length({a})) - 1)"
    step = f"((v + (v & m)) | (v - (v & m))) & {full}"
    return f"(length({a}) - bit_count(list_reduce({masks}, lambda v, m: {step}, {full})))"


def ratio(a: str, b: str) -> str:
    return f"""CASE WHEN {a} = {b} THEN 100 WHEN {a} = '' OR {b} = '' THEN 0
        ELSE CAST(round_even(100 * ((2 * {lcs(a, b)}) / (length({a}) + length({b}))), 0) AS INTEGER) END"""


def fuzzy_base(columns: dict[str, str], threshold: int, keep: int | None = 5) -> str:
    values = " UNION ALL ".join(
        f"SELECT {q(c)} AS c, v FROM (SELECT DISTINCT {c} AS v FROM {source} WHERE {c} IS NOT NULL)"
        for c, source in columns.items()
    )
    words = """list_sort(list_filter(regexp_split_to_array(trim(lower(regexp_replace(regexp_replace(
        v, '[\\x{80}-\\x{FF}]', '', 'g'), '[^\\p{L}\\p{N}_]', ' ', 'g'))), '\\s+'), lambda w: w <> ''))"""
    return f"""vals AS ({values}),
        worded AS (SELECT c, v, {words} AS w FROM vals),
        formed AS (SELECT c, v, array_to_string(w, ' ') AS s, list_sort(list_distinct(w)) AS d FROM worded),
        paired AS (SELECT x.c, x.v AS value, y.v AS match, x.s AS xs, y.s AS ys, x.d AS xd, y.d AS yd,
            list_filter(x.d, lambda t: list_contains(y.d, t)) AS common FROM formed x JOIN formed y USING (c)),
        texts AS (SELECT *, array_to_string(common, ' ') AS t0,
            array_to_string(list_concat(common, list_filter(xd, lambda t: NOT list_contains(yd, t))), ' ') AS t1,
            array_to_string(list_concat(common, list_filter(yd, lambda t: NOT list_contains(xd, t))), ' ') AS t2
            FROM paired),
        scored AS (
            SELECT c, 'token_sort_ratio' AS scorer, value, match, {ratio('xs', 'ys')} AS score FROM texts
            UNION ALL
            SELECT c, 'token_set_ratio', value, match, CASE WHEN t1 = t2 THEN 100 ELSE greatest(
                {ratio('t0', 't1')}, {ratio('t0', 't2')}, {ratio('t1', 't2')}) END FROM texts),
        topped AS (SELECT *, row_number() OVER (PARTITION BY c, scorer, value ORDER BY score DESC, match)
            AS r FROM scored),
        matches AS (SELECT c, scorer, value, match, score FROM topped
            WHERE {f"r <= {keep} AND" if keep else ""} score >= {threshold} AND value < match)"""


def fuzzy_list(scorer: str) -> str:
    return f"""(SELECT c, match AS value, string_agg(value || ': ' || score, ', ' ORDER BY value) AS list
        FROM matches WHERE scorer = {q(scorer)} GROUP BY c, match)"""


# ---- sources and sinks -----------------------------------------------------------------------

NULL_TOKENS = """('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND',
    '1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"""

CSV_SCAN = f"""WITH raw AS (SELECT doc_id, text,
        CASE doc_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN 'n/a' WHEN 2 THEN '' WHEN 3 THEN '<NA>'
            WHEN 4 THEN 'na' ELSE lang END AS label,
        CASE doc_id % 3 WHEN 0 THEN 'NA' ELSE lang END AS country,
        CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE CAST(n_chars AS DOUBLE) END AS amount
        FROM documents)
    SELECT doc_id, CASE WHEN text NOT IN {NULL_TOKENS} THEN text END AS text,
        CASE WHEN label NOT IN {NULL_TOKENS} THEN label END AS label, country, amount FROM raw"""

LOADED = f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END
        AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"""


ORACLES: dict[str, str] = {
    "freq_all_strings": freq("orders", ["o_orderstatus", "o_orderpriority"], "orders"),
    "freq_long_texts": freq("documents", ["text", "lang"], "documents"),
    "freq_long_texts_all": freq(
        "(SELECT html, repeat('same beginning ', 6) || url AS url FROM pages)", ["html", "url"], "pages",
    ).replace("WHERE r <= 50", ""),
    "freq_by_column": freq(
        "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_shipdate"],
        "lineitem",
    ),
    "freq_text": freq_text("customer", ["c_name", "c_mktsegment"]),
    "freq_text_by_column": freq_text("part", ["p_name", "p_size"]),
    "describe_table": describe_report(
        "part", {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string",
                 "p_size": "int", "p_retailprice": "double"},
    ),
    "describe_transposed": describe_all(
        "orders",
        {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
         "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
        3,
    ),
    "numeric_stats": numeric_stats(),
    "numeric_stats_narrowed": numeric_stats(),
    "mean_stats": """SELECT 'o_totalprice' AS column_name, round(avg(o_totalprice), 3) AS mean,
        round(stddev_samp(o_totalprice), 3) AS std,
        round(avg(o_totalprice) + 3 * stddev_samp(o_totalprice), 3) AS upper,
        round(avg(o_totalprice) - 3 * stddev_samp(o_totalprice), 3) AS lower FROM orders""",
    "quartile_stats": " UNION ALL ".join(
        f"SELECT {q(c)} AS column_name, {quartile_fields(f'CAST({c} AS DOUBLE)')} FROM customer"
        for c in ("c_custkey", "c_nationkey", "c_acctbal")
    ),
    "date_quartiles": """WITH s AS (SELECT quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.25) AS q1,
            quantile_cont(CAST(epoch_us(ts) AS DOUBLE), 0.75) AS q3 FROM events)
        SELECT 'ts' AS column_name, make_timestamp(CAST(floor(q1) AS BIGINT)) AS first_quartile,
            make_timestamp(CAST(floor(q3) AS BIGINT)) AS third_quartile,
            (q3 - q1) / 1000000 AS interquartile_range,
            make_timestamp(CAST(floor(q3 + (q3 - q1) * 1.5) AS BIGINT)) AS iq_upper,
            make_timestamp(CAST(floor(q1 - (q3 - q1) * 1.5) AS BIGINT)) AS iq_lower FROM s""",
    "column_profile": " UNION ALL ".join(
        profile_row(c, kind)
        for c, kind in {
            "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
            "c_mktsegment": "string",
        }.items()
    ),
    "histogram": histogram(),
    "profile_run_describe": describe_all(
        "supplier",
        {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
        3,
    ),
    "profile_run_report": describe_report(
        "supplier",
        {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    ),
    "profile_run_frequency": freq("supplier", ["s_name"], "supplier"),
    "profile_run_frequency_text": freq_text("supplier", ["s_name"]),
    "profile_run_profile": " UNION ALL ".join(
        profile_row(c, kind).replace("FROM customer", "FROM supplier")
        for c, kind in {
            "s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double",
        }.items()
    ),
    "nan_statistics": nan_statistics(),
    "nan_outliers": f"""{NAN_FLAGS} SELECT id, abs((coalesce(few, 0) - fm) / fs) > 3 AS "few_isOutlier",
        abs((coalesce(many, 0) - mm) / ms) > 3 AS "many_isOutlier", false AS "endless_isOutlier",
        {fenced('few')} AS few_iq_outlier, {fenced('many')} AS many_iq_outlier,
        {fenced('endless')} AS endless_iq_outlier, coalesce(few < 0 OR few > 9000, false) AS few_outside
        FROM clean, s""",
    "nan_profile": NAN_PROFILE,
    "nan_nulls": f"""WITH {CLEAN_MEASURES} SELECT id, few, many FROM clean
        WHERE id IS NULL OR few IS NULL OR many IS NULL""",
    "nan_verdict": f"""{NAN_FLAGS} SELECT id, abs((coalesce(few, 0) - fm) / fs) > 3 AS "few_isOutlier",
        {fenced('many')} AS many_iq_outlier,
        NOT (abs((coalesce(few, 0) - fm) / fs) > 3) AND NOT {fenced('many')} AS row_is_valid FROM clean, s""",
    "z_outliers": """SELECT event_id, value, abs((value - m) / s) > 3 AS "value_isOutlier"
        FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)""",
    "z_scores": f"""WITH {CONTACTS_CTE}, s AS (SELECT avg(coalesce(revenue, 0)) AS m,
            stddev_pop(coalesce(revenue, 0)) AS d FROM contacts)
        SELECT contact_id, round(abs((coalesce(revenue, 0) - m) / d), 5) AS z_score FROM contacts, s""",
    "iqr_outliers": f"""WITH {CONTACTS_CTE}, s AS (SELECT quantile_cont(revenue, 0.25) AS a,
            quantile_cont(revenue, 0.75) AS b FROM contacts)
        SELECT contact_id, revenue, coalesce(revenue < a - (b - a) * 1.5 OR revenue > b + (b - a) * 1.5,
            false) AS revenue_iq_outlier FROM contacts, s""",
    "iqr_bounds": """WITH s AS (SELECT quantile_cont(o_totalprice, 0.25) AS a,
            quantile_cont(o_totalprice, 0.75) AS b FROM orders)
        SELECT o_orderstatus, max(o_totalprice) AS largest, round(any_value(a - (b - a) * 1.5), 4) AS lower,
            round(any_value(b + (b - a) * 1.5), 4) AS upper FROM orders, s GROUP BY o_orderstatus""",
    "bounds_outliers": """SELECT l_orderkey, l_linenumber, l_extendedprice,
        l_extendedprice < 5000 OR l_extendedprice > 100000 AS is_outlier FROM lineitem""",
    "date_iqr_outliers": """WITH s AS (SELECT quantile_cont(CAST(epoch_us(o_orderdate) AS DOUBLE), 0.25) AS a,
            quantile_cont(CAST(epoch_us(o_orderdate) AS DOUBLE), 0.75) AS b FROM orders)
        SELECT o_orderkey, o_orderdate, epoch_us(o_orderdate) < a - (b - a) * 1.5
            OR epoch_us(o_orderdate) > b + (b - a) * 1.5 AS o_orderdate_date_outlier FROM orders, s""",
    "exact_duplicates": dups(
        "part", "p_partkey", {"p_name": "p_name", "p_retailprice": "p_retailprice"}, "part"
    ),
    "duplicate_texts": dups("documents", "doc_id", {"text": "text"}, "documents"),
    "duplicates_one_column": f"""WITH {CONTACTS_CTE} SELECT contact_id, email FROM (
        SELECT contact_id, email, count(*) OVER (PARTITION BY email) AS n FROM contacts
        WHERE email IS NOT NULL) WHERE n > 1""",
    "distinct_values": f"""WITH {CONTACTS_CTE}
        SELECT DISTINCT first_name FROM contacts WHERE first_name IS NOT NULL""",
    "null_required": """SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
        WHERE quality IS NULL OR toxic IS NULL OR lang IS NULL OR doc_id IS NULL""",
    "null_any_column": f"""WITH {CONTACTS_CTE} SELECT * FROM contacts WHERE contact_id IS NULL
        OR account_id IS NULL OR first_name IS NULL OR last_name IS NULL OR email IS NULL
        OR phone IS NULL OR url IS NULL OR country IS NULL OR revenue IS NULL""",
    "report_projection": f"""WITH {CONTACTS_CTE}
        SELECT contact_id, account_id, email, 'US' AS "DCountry" FROM contacts""",
    "identifiers": """SELECT n_nationkey, replace(replace(replace(trim(' [''' || n_name || '''] '),
        '''', ''), '[', ''), ']', '') AS name FROM nation""",
    "scrub_file": f"""SELECT doc_id, {scrub('text')} AS text, {scrub('lang')} AS lang,
        {scrub('source')} AS source, n_chars FROM documents""",
    "scrub_text": f"""SELECT conv_id, turn, {scrub('role')} AS role, {scrub('text')} AS text,
        trim(nullif({scrub("CASE turn WHEN 0 THEN '' WHEN 1 THEN '  ' ELSE text END")}, '')) AS note
        FROM conversations""",
    "scrub_old": f"""WITH {CONTACTS_CTE} SELECT contact_id, account_id,
        {scrub("CASE WHEN country = 'US' THEN NULL ELSE nullif(trim(first_name), '') END")} AS first_name,
        {scrub('trim(last_name)')} AS last_name, {scrub('trim(email)')} AS email,
        {scrub('trim(phone)')} AS phone, {scrub('trim(url)')} AS url, {scrub('trim(country)')} AS country,
        CASE WHEN country = 'CA' THEN NULL ELSE revenue END AS revenue FROM contacts""",
    "country_rules": f"""WITH {GEO}, {ADDRESSES_CTE} SELECT address_id,
        coalesce(country IN {CODES}, false) AS is_code, {country_code('country')} AS code,
        {country_code('lower(country)')} AS code_of_lower FROM addresses""",
    "country_names": f"""WITH {COUNTRIES_CTE}, names AS (SELECT [{', '.join(
            q(n) for n in lexicon.countries().values())}] AS l),
        picked AS (SELECT c_custkey, l[c_custkey % {len(lexicon.countries())} + 1] AS country
            FROM customer, names)
        SELECT c_custkey, country, (SELECT code FROM countries k WHERE k.name = country) AS code
        FROM picked""",
    "state_rules": f"""WITH {GEO}, {ADDRESSES_CTE},
        a AS (SELECT address_id, state, {country_code('country')} AS cc FROM addresses)
        SELECT address_id, {state_ok('state', 'cc')} AS state_ok, {state_code('state', 'cc')} AS code,
            {state_code('upper(state)', 'cc')} AS code_of_upper, {state_country('state')} AS country_of_state
        FROM a""",
    "city_rules": f"""WITH {CONTACTS_CTE}
        SELECT contact_id, {letters('first_name')} AS city_ok FROM contacts""",
    "title_texts": f"SELECT doc_id, {title('text')} AS title FROM documents",
    "title_names": f"""WITH {CONTACTS_CTE} SELECT contact_id, {title('first_name')} AS first_title,
        {title('last_name')} AS last_title FROM contacts""",
    "zip_rules": f"""WITH {GEO}, {ZIP_CTE}, {ADDRESSES_CTE},
        a AS (SELECT address_id, postal_code, {country_code('country')} AS cc FROM addresses),
        j AS (SELECT a.*, z.zip, z.place, z.state, z.zip IS NOT NULL AS hit,
            CASE WHEN cc = 'US' THEN z.zip IS NOT NULL ELSE {zip_fits('postal_code', 'cc')} END AS good
            FROM a LEFT JOIN zip_ref z ON substr(postal_code, 1, 5) = z.zip)
        SELECT address_id, hit AS is_us_zip, state AS zip_state, place AS zip_city, zip AS record_zip,
            place AS record_place, state AS record_state, {zip_fits('postal_code', 'cc')} AS fits,
            good AS zip_ok, CASE WHEN good THEN
                CASE WHEN cc = 'US' THEN substr(postal_code, 1, 5) ELSE postal_code END END AS zip_text
        FROM j""",
    "zip_large_reference": f"""WITH {LARGE_ZIP_CTE}, {POSTAL_CTE}, r AS (SELECT DISTINCT zip, place, state FROM zip_ref)
        SELECT o_orderkey, r.zip IS NOT NULL AS known, r.place AS place, r.state AS state
        FROM postal LEFT JOIN r ON substr(postal_code, 1, 5) = r.zip""",
    "zip_patterns": f"""WITH a AS (SELECT o_orderkey,
            CASE o_orderkey % 10 WHEN 0 THEN 'US' WHEN 1 THEN 'AU' WHEN 2 THEN 'BR' WHEN 3 THEN 'DE'
                WHEN 4 THEN 'CA' WHEN 5 THEN 'FR' WHEN 6 THEN 'JP' WHEN 7 THEN 'GB' WHEN 8 THEN 'IN'
                ELSE 'ZZ' END AS country,
            CASE o_custkey % 7 WHEN 0 THEN CAST(10000 + o_custkey AS VARCHAR)
                WHEN 1 THEN CAST(10000 + o_custkey AS VARCHAR) || '-1234' WHEN 2 THEN 'K1A 0B1'
                WHEN 3 THEN '123-4567' WHEN 4 THEN 'SW1A 1AA' WHEN 5 THEN '560 001'
                ELSE '01310100' END AS code FROM orders)
        SELECT o_orderkey, country, code, {zip_fits('code', 'country')} AS fits FROM a""",
    "zip_reverse": f"""WITH {ZIP_CTE}, {ADDRESSES_CTE}, l AS (SELECT place, state,
            string_agg(zip, ',' ORDER BY zip) AS zips FROM zip_ref GROUP BY place, state)
        SELECT address_id, coalesce(zips, '') AS zips FROM addresses a
        LEFT JOIN l ON a.city = l.place AND a.state = l.state""",
    "phone_rules_contacts": f"""WITH {COUNTRIES_CTE}, {CONTACTS_CTE},
        a AS (SELECT contact_id, phone, {country_code('country')} AS cc FROM contacts)
        SELECT contact_id, CASE WHEN cc = 'US' THEN {clean_phone('phone')} ELSE phone END AS clean,
            CASE WHEN cc = 'US' THEN {phone_formatted('phone')} ELSE phone END AS formatted,
            CASE WHEN cc = 'US' THEN {phone_ext('phone')} END AS ext,
            coalesce(cc IN ('US', 'CA') AND {phone_ok('phone')}, false) AS is_valid FROM a""",
    "phone_validate": f"""WITH {COUNTRIES_CTE}, {CONTACTS_CTE}, src AS (SELECT * FROM contacts),
        {PHONE_RESULT} SELECT contact_id, phone, country, valid, formatted, ext FROM phoned""",
    "phone_in_documents": f"""WITH {COUNTRIES_CTE}, src AS (SELECT doc_id, 'US' AS country,
            unnest(regexp_extract_all(text, '\\(\\d{{3}}\\) \\d{{3}}-\\d{{4}}')) AS phone FROM documents),
        {PHONE_RESULT} SELECT doc_id, phone, valid, formatted, ext FROM phoned""",
    "email_rules": f"""WITH {CONTACTS_CTE} SELECT contact_id, {email_ok('email')} AS email_ok,
        {email_normal('email')} AS normalized FROM contacts""",
    "email_in_documents": f"""WITH d AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\S+@\\S+')) AS email
            FROM documents)
        SELECT doc_id, email, {email_ok('email')} AS email_ok, {email_normal('email')} AS normalized FROM d""",
    "url_rules": f"""SELECT page_id, {url_ok('url')} AS as_given,
        {url_ok("regexp_replace(url, '^https?://', '')")} AS no_scheme,
        {url_ok("replace(url, '//', '/')")} AS one_slash, {url_ok("('mailto:' || url)")} AS mail,
        {url_ok("(' ' || url)")} AS led_by_blank, {url_ok("('http:///' || url)")} AS no_host,
        {url_ok("replace(url, '://', '://[')")} AS open_bracket, false AS nothing FROM pages""",
    "name_rules": f"""WITH {CONTACTS_CTE} SELECT contact_id, {letters('first_name')} AS name_ok,
        CASE WHEN {letters('first_name')} THEN first_name
            ELSE trim(regexp_replace(first_name, '[^A-Za-z ''\\-]+', '', 'g')) END AS formatted,
        CASE WHEN {letters('last_name')} THEN last_name
            ELSE trim(regexp_replace(last_name, '[^A-Za-z ''\\-]+', '', 'g')) END AS last_formatted
        FROM contacts""",
    "address_assemble": f"WITH {ADDRESSES_CTE} SELECT address_id, {FULL_TEXT} AS full_text FROM addresses",
    "address_parse": f"""WITH {GEO}, {ADDRESSES_CTE},
        a AS (SELECT address_id, {FULL_TEXT} AS t, {country_code('country')} AS cc FROM addresses),
        b AS (SELECT address_id, cc, {parse('t', 'cc')} AS x FROM a),
        c AS (SELECT address_id, cc, CASE WHEN x.street_number <> '' THEN x END AS x FROM b)
        SELECT address_id, {PARSED} FROM c""",
    "address_between": """SELECT doc_id, CASE WHEN strpos(text, 'the') > 0 AND strpos(text, lang) > 0
        THEN regexp_replace(substr(text, strpos(text, 'the') + 4,
            greatest(strpos(text, lang) - strpos(text, 'the') - 4, 0)),
            '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') END AS between FROM documents""",
    "address_messages": f"""WITH {ADDRESS_BASE}, {MAIN}
        SELECT address_id, messages = '' AS a_addr_is_valid, messages, street AS a_street,
            suite AS a_suite, city2 AS a_city, state2 AS a_state, postal AS a_postal_code,
            country2 AS a_country FROM main_done""",
    "address_key": f"""WITH {ADDRESS_BASE}, {MAIN}
        SELECT address_id, match_key AS a_full_address FROM main_done""",
    "address_duplicates": dups(
        "joined", "address_id",
        {c: c for c in ("main_full_address", "backup_full_address")}, "addresses", BOTH,
    ),
    "address_summary": f"WITH {BOTH} SELECT *, main_addr_is_valid AS row_is_valid FROM joined",
    "address_street_types": f"""WITH {LINES_CTE}, b AS (SELECT line_id, {parse('line', "'US'")} AS x FROM street_lines),
        c AS (SELECT line_id, 'US' AS cc, CASE WHEN x.street_number <> '' THEN x END AS x FROM b)
        SELECT line_id, {PARSED} FROM c""",
    "address_frequency": freq(
        "joined", [f"{p}_{c}" for c in ("addr_is_valid", "addr_error_messg") for p in ("main", "backup")],
        "addresses", BOTH + ", ",
    ),
    "validation_summary": f"{CHECKED_CONTACTS} SELECT * FROM flagged",
    "stream_verdict": f"""{CHECKED_CONTACTS} SELECT * EXCLUDE ("revenue_isOutlier", revenue_iq_outlier)
        REPLACE (phone_is_valid AND email_check AND first_name_check AS row_is_valid) FROM flagged""",
    "fuzzy_matches": f"""WITH {fuzzy_base({'p_name': 'part'}, 85)}
        SELECT scorer, value, match, score FROM matches""",
    "fuzzy_low_threshold": f"""WITH {fuzzy_base({'p_name': 'part'}, 70)}
        SELECT scorer, value, match, score FROM matches""",
    **{
        f"fuzzy_suppliers_{name}": f"""WITH {fuzzy_base({'s_name': 'supplier'}, threshold, keep)}
        SELECT scorer, value, match, score FROM matches"""
        for name, threshold, keep in (("60", 60, 5), ("85", 85, 5), ("95", 95, 5), ("all", 94, None))
    },
    "fuzzy_compare": f"""WITH {fuzzy_base({'p_name': 'part'}, 85)}
        SELECT c AS table_column, value, coalesce(s.list, '') AS token_sort_ratio,
            coalesce(t.list, '') AS token_set_ratio, 'part' AS table_name
        FROM {fuzzy_list('token_sort_ratio')} s FULL JOIN {fuzzy_list('token_set_ratio')} t
        USING (c, value)""",
    "fuzzy_multi": f"""WITH {fuzzy_base({'p_name': 'part', 'p_type': 'part'}, 60)}
        SELECT c AS table_column, scorer, value, score, string_agg(match, ', ' ORDER BY match) AS match
        FROM matches WHERE scorer = 'token_sort_ratio' GROUP BY c, scorer, value, score
        UNION ALL
        SELECT c, scorer, string_agg(value, ', ' ORDER BY value), score, match
        FROM matches WHERE scorer = 'token_set_ratio' GROUP BY c, scorer, match, score""",
    "csv_scan": CSV_SCAN,
    "query_scan": """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
    "query_file_scan": "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal < 0",
    "table_sinks": "SELECT * FROM orders UNION ALL SELECT * FROM orders",
    "report_sink": f"""WITH {CONTACTS_CTE} SELECT contact_id, first_name, email, phone FROM contacts""",
    "typed_load": LOADED,
    "static_type_load": LOADED,
    "batch_run": f"""{CHECKED_CONTACTS} SELECT 'contacts' AS dataset, 'done' AS status, '' AS detail, contact_id,
        row_is_valid FROM flagged UNION ALL SELECT 'other', 'skipped', 'no configuration', NULL, NULL
        UNION ALL SELECT 'notes.txt', 'skipped', 'not a .csv file', NULL, NULL""",
    "registry_run": f"""{CHECKED_CONTACTS}, fences AS (SELECT quantile_cont(s_acctbal, 0.25) AS a, quantile_cont(s_acctbal, 0.75) AS b
            FROM supplier)
        SELECT 'crm_contact_export' AS dataset, 'done' AS status, '' AS detail, contact_id AS key, row_is_valid FROM flagged
        UNION ALL SELECT 'GPVendors', 'done', '', s_suppkey, s_acctbal BETWEEN a - (b - a) * 1.5 AND b + (b - a) * 1.5
            FROM supplier, fences
        UNION ALL SELECT 'orphan', 'skipped', 'no configuration', NULL, NULL
        UNION ALL SELECT 'NoKey', 'skipped', 'no single primary key', NULL, NULL""",
    "contact_duplicates_email": f"""WITH {CONTACTS_CTE} SELECT contact_id, email FROM (
        SELECT contact_id, email, count(*) OVER (PARTITION BY email) AS n FROM contacts
        WHERE email IS NOT NULL) WHERE n > 1""",
    "contact_phone_frequency": contact_freq(["phone_is_valid"]),
    "contact_email_frequency": contact_freq(["email_check"]),
    "contact_iqr_outliers_frequency": contact_freq(["revenue_iq_outlier"]),
    "contact_phone_detail": contact_detail(
        "phone", "country", "phone_is_valid", "phone_formatted", "phone_ext_formatted"
    ),
    "contact_email_detail": contact_detail("email", "email_normalized", "email_check"),
    "contact_url_detail": contact_detail("url", "url_is_valid"),
    "contact_name_detail": contact_detail("first_name", "first_name_check"),
    "contact_z_detail": contact_detail("revenue", '"revenue_isOutlier"'),
    "contact_iqr_detail": contact_detail("revenue", "revenue_iq_outlier"),
    "contact_duplicates": dups(
        "contacts", "contact_id", {"email": "email", "first_name": "first_name"}, "contacts",
        CONTACTS_CTE,
    ),
    "contact_nulls": f"""WITH {CONTACTS_CTE} SELECT contact_id, account_id, first_name, email, phone
        FROM contacts WHERE contact_id IS NULL OR account_id IS NULL OR first_name IS NULL
        OR email IS NULL OR phone IS NULL""",
    "check_frequency": contact_freq(CHECKS),
    "row_frequency": contact_freq(["row_is_valid"]),
    "column_frequency": contact_freq(
        ["contact_id", "account_id", "row_is_valid", "phone", "country", "phone_is_valid",
         "phone_formatted", "phone_ext_formatted", "email", "email_normalized", "email_check", "url",
         "url_is_valid", "first_name", "first_name_check", "revenue", "revenue_isOutlier",
         "revenue_iq_outlier"]
    ),
}
