"""The catalog's queries as plain SQL, for checking results in another engine.

The SQL takes the long way round on purpose: it joins records pair by pair and
fills dynamic-programming tables row by row, where the Spark side folds,
prunes and shares work.
"""

from __future__ import annotations

# Fixed values, as in the operators: kept characters here, check weights and reply patterns below.
KEPT = "[^A-Z0-9ĄĆĘŁŃÓŚŹŻ ]"


def _std(column: str) -> str:
    return f"regexp_replace(upper({column}), '{KEPT}', '', 'g')"


def _fuzzy(a: str, b: str) -> str:
    return f"(1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / nullif(greatest(length({a}), length({b})), 0)::DOUBLE)"


def _soundex(a: str) -> str:
    letters = f"regexp_replace(upper({a}), '[^A-Z]', 'A', 'g')"
    heard = f"left({letters}, 1) || regexp_replace(substr({letters}, 2), '[HW]', '', 'g')"
    code = f"translate({heard}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"
    for digit in "123456":
        code = f"regexp_replace({code}, '{digit}+', '{digit}', 'g')"
    tail = f"replace(substr({code}, 2), '0', '')"
    return f"left(rpad(left({letters}, 1) || {tail}, 4, '0'), 4)"


def _lcs(a: str, b: str) -> str:
    """Common subsequence length; one list per row of the table."""
    flags = (
        f"list_transform(string_split({a}, ''), lambda ca: "
        f"list_transform(string_split({b}, ''), lambda cb: CASE WHEN ca = cb THEN 1 ELSE 0 END))"
    )
    row = (
        "list_transform(range(1, len(acc) + 1), lambda j: list_max(list_transform(range(1, j + 1), "
        "lambda k: greatest(acc[k], coalesce(acc[k - 1], 0) + hit[k]))))"
    )
    start = f"list_transform(string_split({b}, ''), lambda c: 0)"
    return f"list_reduce({flags}, lambda acc, hit: {row}, {start})[length({b})]"


RECORDS = f"""rec AS (
  SELECT p_partkey AS cust_id, {_std('p_name')} AS fname, {_std('p_brand')} AS lname,
         {_std('p_type')} AS address
  FROM part)"""

PROFILES = """prof AS (
  SELECT fname, lname, address, min(cust_id) AS profile, max(cust_id) AS profile_last,
    count(*) AS profile_members
  FROM rec WHERE fname IS NOT NULL GROUP BY ALL),
tagged AS (
  SELECT r.cust_id, r.fname, p.profile FROM rec r JOIN prof p
  ON r.fname = p.fname AND r.lname IS NOT DISTINCT FROM p.lname
     AND r.address IS NOT DISTINCT FROM p.address),
met AS (
  SELECT least(a.profile, b.profile) AS profile1, greatest(a.profile, b.profile) AS profile2,
         count(*) AS pairs
  FROM tagged a JOIN tagged b ON a.fname = b.fname AND a.cust_id < b.cust_id
  GROUP BY ALL)"""

PROFILE_PAIR = """p.fname, p.lname AS lname1, p.address AS address1, m.profile1, p.profile_last AS profile_last1,
  p.profile_members AS profile_members1, q.lname AS lname2, q.address AS address2, m.profile2, q.profile_last AS profile_last2,
  q.profile_members AS profile_members2, m.pairs"""
PROFILE_JOIN = "met m JOIN prof p ON m.profile1 = p.profile JOIN prof q ON m.profile2 = q.profile"

FIRST, LAST, PLACE = ("p.fname", "p.fname"), ("p.lname", "q.lname"), ("p.address", "q.address")


def _scores(first: tuple[str, str], last: tuple[str, str], place: tuple[str, str]) -> str:
    return f"""round({_fuzzy(*first)}, 6) AS fname_fuzzy,
  round({_fuzzy(_soundex(first[0]), _soundex(first[1]))}, 6) AS fname_soundex,
  round({_fuzzy(*last)}, 6) AS lname_fuzzy,
  round({_fuzzy(_soundex(last[0]), _soundex(last[1]))}, 6) AS lname_soundex,
  round({_fuzzy(*place)}, 6) AS address_fuzzy"""


RECORD_PAIRS = """pairs AS (
  SELECT a.cust_id AS cust_id1, b.cust_id AS cust_id2, a.fname AS fname1, b.fname AS fname2,
         a.lname AS lname1, b.lname AS lname2, a.address AS address1, b.address AS address2
  FROM rec a JOIN rec b ON a.fname = b.fname AND a.cust_id < b.cust_id)"""
PAIR_VALUES = (("fname1", "fname2"), ("lname1", "lname2"), ("address1", "address2"))

NEIGHBOURS = """pairs AS (
  SELECT a.p_partkey, a.p_name || ' ' || a.p_brand AS l, b.p_name || ' ' || b.p_brand AS r
  FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1)"""


def _by_pair(columns: str) -> str:
    return f"WITH {NEIGHBOURS} SELECT p_partkey, {columns} FROM pairs"


def _by_value(columns: str, alias: str, extra: str = "") -> str:
    """Score distinct values once, then join back."""
    return f"""WITH {NEIGHBOURS}, vals AS (SELECT DISTINCT l, r FROM pairs){extra},
    scored AS (SELECT l, r, {columns} FROM vals)
    SELECT p_partkey, {alias} FROM pairs JOIN scored USING (l, r)"""


def _ratio(common: str, a: str, b: str) -> str:
    return f"round_even(100.0 * (2.0 * {common}::DOUBLE / (length({a}) + length({b}))::DOUBLE), 0)::INTEGER"


TERMS = """(VALUES ('BLUE','BLU','NAME'), ('SMALL','SML','NAME'), ('LARGE','LRG','NAME'),
  ('WIDGET','WDG','ADDRESS'), ('PLATE','PLT','ADDRESS'), ('SMALL','SM','ADDRESS'),
  ('ECONOMY','ECO','ADDRESS'), ('STANDARD','STD','ADDRESS')) AS dict(token, term, context)"""

NAMED = f"""named AS (
  SELECT p_partkey AS cust_key, upper(split_part(p_name, ' ', 1)) AS fname FROM part),
standard AS (
  SELECT cust_key, fname, nullif(coalesce(d.term, fname), fname) AS fname_std
  FROM named LEFT JOIN (SELECT * FROM {TERMS} WHERE context = 'NAME') d ON fname = d.token)"""

TOKENS = f"""addr AS (
  SELECT p_partkey AS cust_key, upper(p_name) || '  ' || p_type AS address FROM part),
words AS (
  SELECT cust_key, unnest(string_split(address, ' ')) AS word,
         generate_subscripts(string_split(address, ' '), 1) AS idx FROM addr),
standard_address AS (
  SELECT cust_key,
    trim(regexp_replace(string_agg(coalesce(d.term, word), ' ' ORDER BY idx), '[^A-Z0-9]+', ' ', 'g')) AS address
  FROM words LEFT JOIN (SELECT * FROM {TERMS} WHERE context = 'ADDRESS') d ON word = d.token
  WHERE word > '' GROUP BY cust_key),
written AS (
  SELECT a.cust_key, a.address, CASE WHEN a.address <> s.address THEN s.address END AS address_std
  FROM addr a LEFT JOIN standard_address s USING (cust_key))"""

LOOSE = f"""WITH loose AS (
  SELECT CASE WHEN p_partkey % 7 > 0 THEN (p_partkey % 5)::VARCHAR END AS cust_key, upper(p_name) || '  ' || upper(p_type) AS address
  FROM part),
texts AS (SELECT DISTINCT address FROM loose),
words AS (
  SELECT address, unnest(string_split(address, ' ')) AS word,
         generate_subscripts(string_split(address, ' '), 1) AS idx FROM texts),
standard AS (
  SELECT address,
    trim(regexp_replace(string_agg(coalesce(d.term, word), ' ' ORDER BY idx), '[^A-Z0-9]+', ' ', 'g')) AS found
  FROM words LEFT JOIN (SELECT * FROM {TERMS} WHERE context = 'ADDRESS') d ON word = d.token
  WHERE word > '' GROUP BY address)
SELECT cust_key, address, CASE WHEN address <> found THEN found END AS address_std
FROM loose LEFT JOIN standard USING (address)"""

TEN = "lpad((c_custkey * 7919 + 12345)::VARCHAR, 10, '0')"
CHECK = "((10 - (" + " + ".join(
    f"substr(ten, {place}, 1)::INTEGER * {weight}"
    for place, weight in enumerate((1, 3, 7, 9, 1, 3, 7, 9, 1, 3), start=1)
) + ") % 10) % 10)"
IDENTIFIERS = f"""base AS (SELECT c_custkey, {TEN} AS ten FROM customer),
digits AS (SELECT *, {CHECK} AS digit FROM base),
people AS (
  SELECT c_custkey, CASE c_custkey % 10
    WHEN 0 THEN NULL WHEN 1 THEN '00000000000'
    WHEN 2 THEN ten || ((digit + 1) % 10)::VARCHAR WHEN 3 THEN ten
    WHEN 4 THEN 'A' || substr(ten, 2, 9) || digit::VARCHAR
    ELSE ten || digit::VARCHAR END AS pesel
  FROM digits)"""
VALID = f"""CASE WHEN regexp_full_match(coalesce(pesel, ''), '[0-9]{{11}}')
  THEN substr(pesel, 11, 1)::INTEGER = {CHECK.replace('ten', 'pesel')} ELSE FALSE END"""
MALFORMED = "(pesel IS NULL OR NOT regexp_full_match(pesel, '[0-9]{11}') OR pesel = '00000000000')"

DAILY = """daily AS (
  SELECT date_trunc('day', ts)::TIMESTAMP AS measurement_time, event_type || '_count' AS metric_name,
         count(*)::DOUBLE AS value FROM events GROUP BY ALL)"""

MEASURED = f"""measured AS (
  SELECT 'customer' AS table_name, 'pesel' AS column_name, 'INVALID_PESEL_COUNT' AS metric_name,
    (count(*) FILTER {MALFORMED})::DOUBLE AS value FROM people
  UNION ALL SELECT 'customer', 'pesel', 'NULL_COUNT', (count(*) FILTER (pesel IS NULL))::DOUBLE FROM people
  UNION ALL SELECT 'customer', 'c_custkey', 'NULL_COUNT', (count(*) FILTER (c_custkey IS NULL))::DOUBLE FROM people
  UNION ALL SELECT 'events', 'value', 'NULL_COUNT', (count(*) FILTER (value IS NULL OR event_type = 'error'))::DOUBLE FROM events
  UNION ALL SELECT 'events', 'event_type', 'NULL_COUNT', (count(*) FILTER (event_type IS NULL))::DOUBLE FROM events
  UNION ALL SELECT 'events', 'event_id', 'ROW_COUNT', count(*)::DOUBLE FROM events)"""

ALIGNED = "s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal"

ORACLES: dict[str, str] = {
    "row_counts": """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
        UNION ALL SELECT 'supplier', count(*) FROM supplier""",
    "union_sources": f"""SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
          'customer' AS SOURCE_SYSTEM FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""",
    "union_fillers": f"""SELECT c_custkey, c_name, c_nationkey, NULL::DOUBLE AS c_acctbal, c_mktsegment,
          '' AS supplier_code FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, ' ', s_suppkey::VARCHAR FROM supplier""",
    "csv_load": """SELECT c_custkey, CASE WHEN c_custkey % 10 = 7 THEN 'a, "b" ' || c_name ELSE c_name END AS c_name,
          CASE WHEN c_custkey % 10 IN (4, 5, 6) THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment
        FROM customer WHERE c_custkey % 10 NOT IN (1, 2, 3, 8, 9) OR (c_custkey % 10 = 3 AND length(c_mktsegment) * 2 <= 10)""",
    "csv_rejects": """SELECT CASE c_custkey % 10
            WHEN 1 THEN c_custkey || ',' || c_name || ',none,' || c_mktsegment
            WHEN 2 THEN c_custkey || ',' || c_name
            WHEN 8 THEN c_custkey || ',"a, ""b"" ' || c_name || '", none ,' || c_mktsegment
            WHEN 9 THEN c_custkey || ',"' || c_name || ',' || c_acctbal || ',' || c_mktsegment
            ELSE c_custkey || ',' || c_name || ',' || c_acctbal || ',' || c_mktsegment || c_mktsegment END AS raw,
          CASE c_custkey % 10 WHEN 1 THEN 'cast c_acctbal' WHEN 2 THEN 'field count'
            WHEN 8 THEN 'cast c_acctbal' WHEN 9 THEN 'open quote' ELSE 'length c_mktsegment' END AS reason
        FROM customer WHERE c_custkey % 10 IN (1, 2, 8, 9) OR (c_custkey % 10 = 3 AND length(c_mktsegment) * 2 > 10)""",
    "csv_semicolon": "SELECT n_nationkey, n_name || ', ' || n_regionkey AS n_name FROM nation",
    "list_files": "SELECT DISTINCT c_mktsegment AS segment, true AS filled FROM customer",
    "standardize_table": f"""SELECT p_partkey, {_std('p_name')} AS p_name, {_std('p_brand')} AS p_brand,
        trim({_std('p_type')}) AS p_type FROM part""",
    "stable_ids": "SELECT count(*) AS ids, 1::BIGINT AS first_id, count(*) AS last_id FROM orders",
    "stable_ids_ordered": """SELECT row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS cust_id,
        c_custkey, c_mktsegment FROM customer""",
    "regex_street": "SELECT p_partkey, p_name FROM part WHERE regexp_full_match(p_name, '(?i) *R.*')",
    "regex_house": """SELECT * FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size::VARCHAR || '/2'
          WHEN 1 THEN p_size::VARCHAR || 'A' WHEN 2 THEN p_size::VARCHAR END AS house_number FROM part)
        WHERE regexp_full_match(house_number, '.*[^0-9].*')""",
    "build_samples": f"""WITH person AS (
          SELECT c_custkey, c_nationkey, 'no. ' || split_part(c_name, '#', 2) AS first_name,
            CASE WHEN c_custkey % 5 > 0 THEN c_mktsegment END AS last_name FROM customer),
        place AS (
          SELECT n_nationkey, n_nationkey || ' ' || n_name || ' ' ||
            CASE WHEN n_nationkey <> 3 THEN 'street' END AS line,
            CASE WHEN n_nationkey > 5 THEN r_name END AS city, r_name AS state, n_regionkey AS zip
          FROM nation JOIN region ON n_regionkey = r_regionkey)
        SELECT c_custkey::VARCHAR AS cust_key, c_nationkey::VARCHAR AS add_key, {_std('first_name')} AS fname,
          {_std('last_name')} AS lname, {_std('line')} AS address, {_std('city')} AS city,
          {_std('state')} AS state, zip::VARCHAR AS zip
        FROM person JOIN place ON c_nationkey = n_nationkey
        WHERE first_name IS NOT NULL AND last_name IS NOT NULL AND line IS NOT NULL
          AND state IS NOT NULL AND zip IS NOT NULL""",
    "short_values": f"WITH {NAMED} SELECT DISTINCT fname FROM named WHERE length(fname) < 5",
    "prefix_values": f"WITH {RECORDS} SELECT DISTINCT fname FROM rec WHERE fname LIKE 'SMALL%'",
    "dictionary_values": f"WITH {NAMED} SELECT * FROM standard",
    "changed_rows": f"WITH {NAMED} SELECT * FROM standard WHERE fname <> fname_std",
    "dictionary_tokens": f"WITH {TOKENS} SELECT * FROM written",
    "dictionary_tokens_joined": LOOSE,
    "dictionary_tokens_embedded": LOOSE,
    "text_standards": r"""WITH d AS (SELECT doc_id, text, regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9ĄĆĘŁŃÓŚŹŻ ]', '', 'g') AS opening FROM documents),
        lw AS (SELECT doc_id, unnest(regexp_extract_all(upper(replace(text, 'ß', 'ss')), '\w+')) AS w FROM d),
        rw AS (SELECT doc_id, unnest(regexp_extract_all(opening, '\w+')) AS w FROM d),
        lc AS (SELECT doc_id, w, count(*) AS n FROM lw GROUP BY ALL), rc AS (SELECT doc_id, w, count(*) AS n FROM rw GROUP BY ALL),
        ln AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM lc GROUP BY ALL), rn AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM rc GROUP BY ALL),
        dot AS (SELECT doc_id, sum(lc.n * rc.n) AS hit FROM lc JOIN rc USING (doc_id, w) GROUP BY ALL)
        SELECT doc_id, regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9ĄĆĘŁŃÓŚŹŻ ]', '', 'g') AS standard,
          trim(regexp_replace(upper(replace(text, 'ß', 'ss')), '[^A-Z0-9ĄĆĘŁŃÓŚŹŻ]+', ' ', 'g')) AS tokens,
          round(coalesce(hit, 0) / (ln.norm * rn.norm), 6) AS cosine
        FROM d LEFT JOIN ln USING (doc_id) LEFT JOIN rn USING (doc_id) LEFT JOIN dot USING (doc_id)""",
    "large_changes": f"WITH {TOKENS} SELECT * FROM written WHERE levenshtein(address, address_std) > 3",
    "dictionary_checks": """WITH keys AS (
          SELECT p_brand AS token, p_type AS context, count(*) AS entries,
            count(*) FILTER (p_size <= 3) AS with_null FROM part GROUP BY ALL)
        SELECT token, context, entries, 'null' AS problem FROM keys WHERE with_null > 0
        UNION ALL SELECT token, context, entries, 'duplicate' FROM keys WHERE entries > 1""",
    "city_lookup": """SELECT c_custkey, c.c_nationkey, n_name AS match_code FROM (
          SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey
          FROM customer) c LEFT JOIN nation ON c.c_nationkey = n_nationkey""",
    "correct_addresses": """SELECT c_custkey, r_name, n_name,
          CASE WHEN r_name = 'ASIA' THEN 'no idea'
            ELSE 'City: ' || r_name || ', Street: ' || n_name || ', Poland' END AS llm,
          CASE WHEN r_name <> 'ASIA' THEN r_name END AS miasto,
          CASE WHEN r_name <> 'ASIA' THEN n_name END AS street
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "parse_replies": """WITH said AS (SELECT p_partkey,
          CASE WHEN p_partkey % 3 = 0 THEN 'City: ' ELSE 'CITY:' END || p_name ||
          CASE WHEN p_partkey % 2 = 0 THEN ', ' ELSE ' ' END ||
          CASE WHEN p_partkey % 5 > 0 THEN 'street: ' ELSE 'road: ' END || p_brand AS llm FROM part)
        SELECT p_partkey, llm,
          nullif(trim(regexp_extract(llm, '(?i)city:\\s*([^,]+),?\\s*street', 1)), '') AS miasto,
          nullif(trim(regexp_extract(llm, '(?i)street:\\s*([^,]+)', 1)), '') AS street FROM said""",
    "pesel_audit": f"WITH {IDENTIFIERS} SELECT c_custkey, pesel, {VALID} AS pesel_valid FROM people",
    "pesel_metric": f"""WITH {IDENTIFIERS} SELECT count(*) AS records,
        count(*) FILTER ({VALID}) AS checksum_valid, count(*) FILTER {MALFORMED} AS format_invalid FROM people""",
    "metric_evaluate": f"""WITH {IDENTIFIERS}
        SELECT 'pesel' AS column_name, 'INVALID_PESEL_COUNT' AS metric_name,
          (count(*) FILTER {MALFORMED})::DOUBLE AS value FROM people
        UNION ALL SELECT 'pesel', 'NULL_COUNT', (count(*) FILTER (pesel IS NULL))::DOUBLE FROM people
        UNION ALL SELECT 'c_custkey', 'ROW_COUNT', count(*)::DOUBLE FROM people""",
    "metric_history": f"""WITH {DAILY} SELECT measurement_time, 'events' AS table_name,
          'event_type' AS column_name, metric_name, value FROM daily
        WHERE metric_name = 'error_count' ORDER BY measurement_time DESC""",
    "metric_latest": f"""WITH {DAILY} SELECT 'events' AS table_name, 'event_type' AS column_name,
        metric_name, max(measurement_time) AS measurement_time,
        max_by(value, measurement_time) AS value FROM daily GROUP BY metric_name""",
    "metric_bindings": f"""WITH {IDENTIFIERS}, {MEASURED}
        SELECT *, CASE table_name WHEN 'customer' THEN '1440 minutes' ELSE '5 minutes' END AS schedule FROM measured""",
    "metric_tables": f"WITH {IDENTIFIERS}, {MEASURED} SELECT *, 2::BIGINT AS measured FROM measured",
    "metric_listing": f"""WITH {IDENTIFIERS}, {MEASURED} SELECT 'QUALITY_METRICS' AS schema_name, metric_name, table_name, value
        FROM measured WHERE metric_name = 'INVALID_PESEL_COUNT'""",
    "monitor_stream": """SELECT 'ROW_COUNT' AS metric_name, count(*)::DOUBLE AS value FROM events
        UNION ALL SELECT 'NULL_COUNT', (count(*) FILTER (value IS NULL OR event_type = 'error'))::DOUBLE FROM events""",
    "pair_estimate": f"""WITH {RECORDS}, sizes AS (SELECT fname, count(*) AS n FROM rec GROUP BY fname)
        SELECT 'none' AS blocking, 1::BIGINT AS blocks, count(*) AS records, count(*) AS largest_block,
          count(*) * count(*) AS ordered_pairs, (count(*) * (count(*) - 1)) // 2 AS candidate_pairs FROM rec
        UNION ALL SELECT 'fname', count(*), sum(n)::BIGINT, max(n), sum(n * n)::BIGINT,
          (SELECT count(*) FROM rec a JOIN rec b ON a.fname = b.fname AND a.cust_id < b.cust_id) FROM sizes""",
    "block_sizes": f"WITH {RECORDS} SELECT fname, count(*) AS records FROM rec GROUP BY fname ORDER BY 2 DESC, 1",
    "block_pair_count": f"""WITH {RECORDS}, one AS (SELECT * FROM rec WHERE fname = 'SMALL RING')
        SELECT (SELECT count(*) FROM one) AS records,
          (SELECT count(*) FROM one a, one b) AS all_pairs,
          (SELECT count(*) FROM one a, one b WHERE a.cust_id < b.cust_id) AS ordered_once""",
    "candidate_pairs": f"WITH {RECORDS}, {PROFILES} SELECT {PROFILE_PAIR} FROM {PROFILE_JOIN}",
    "pair_scores": f"""WITH {RECORDS}, {PROFILES}
        SELECT {PROFILE_PAIR}, {_scores(FIRST, LAST, PLACE)} FROM {PROFILE_JOIN}""",
    "duplicate_links": f"""WITH {RECORDS}, {PROFILES}
        SELECT * FROM (SELECT {PROFILE_PAIR}, {_scores(FIRST, LAST, PLACE)} FROM {PROFILE_JOIN})
        WHERE fname_soundex >= 0.4 AND fname_fuzzy >= 0.4 AND lname_fuzzy >= 0.4 AND address_fuzzy >= 0.4""",
    "large_block_candidates": f"""WITH c AS (SELECT c_custkey, {_std('c_mktsegment')} AS segment FROM customer)
        SELECT a.segment, a.c_custkey AS cust_id, count(*) AS pairs, max(b.c_custkey) AS last_partner
        FROM c a JOIN c b ON a.segment = b.segment AND a.c_custkey < b.c_custkey GROUP BY ALL""",
    "large_block_links": f"""WITH c AS (SELECT c_custkey, c_name, {_std('c_mktsegment')} AS segment FROM customer)
        SELECT a.segment, a.c_custkey AS profile1, b.c_custkey AS profile2, 1::BIGINT AS pairs,
          round({_fuzzy('a.c_name', 'b.c_name')}, 6) AS name_fuzzy
        FROM c a JOIN c b ON a.segment = b.segment AND a.c_custkey < b.c_custkey
        WHERE {_fuzzy('a.c_name', 'b.c_name')} >= 0.9""",
    "record_profiles": f"WITH {RECORDS}, {PROFILES} SELECT cust_id, profile FROM tagged",
    "duplicate_records": f"""WITH {RECORDS}, {RECORD_PAIRS}
        SELECT * FROM (SELECT cust_id1, cust_id2, fname1 AS fname, lname1, lname2, address1, address2, {_scores(*PAIR_VALUES)}
          FROM pairs)
        WHERE fname_soundex >= 0.4 AND fname_fuzzy >= 0.4 AND lname_fuzzy >= 0.4 AND address_fuzzy >= 0.4""",
    "candidate_preview": f"""WITH {RECORDS}, {RECORD_PAIRS}
        SELECT * FROM pairs ORDER BY cust_id1 || '-' || cust_id2 LIMIT 10""",
    "score_preview": f"""WITH {RECORDS}, {RECORD_PAIRS}
        SELECT cust_id1 || '-' || cust_id2 AS pair_key, cust_id1, cust_id2, {_scores(*PAIR_VALUES)}
        FROM pairs ORDER BY pair_key LIMIT 100""",
    "duplicate_listing": f"""WITH {RECORDS}, {RECORD_PAIRS}, likely AS (
          SELECT * FROM (SELECT cust_id1 || '-' || cust_id2 AS pair_key, cust_id1, cust_id2,
            {_scores(*PAIR_VALUES)} FROM pairs)
          WHERE fname_soundex >= 0.4 AND fname_fuzzy >= 0.4 AND lname_fuzzy >= 0.4 AND address_fuzzy >= 0.4)
        SELECT pair_key, b.* FROM likely c JOIN rec b ON b.cust_id = c.cust_id1
        UNION SELECT pair_key, b.* FROM likely c JOIN rec b ON b.cust_id = c.cust_id2
        ORDER BY pair_key, cust_id LIMIT 100""",
    "score_levenshtein": _by_pair(
        f"levenshtein(l, r)::INTEGER AS levenshtein, round({_fuzzy('l', 'r')}, 6) AS fuzzy"
    ),
    "score_soundex": _by_pair(f"round({_fuzzy(_soundex('l'), _soundex('r'))}, 6) AS soundex"),
    "score_hamming": _by_pair(
        "CASE WHEN length(l) = length(r) THEN hamming(l, r)::INTEGER END AS hamming"
    ),
    "score_jaccard": _by_pair(
        "round(jaccard(l, r), 6) AS jaccard_similarity, round(1 - jaccard(l, r), 6) AS jaccard_distance"
    ),
    "score_cosine": f"""WITH {NEIGHBOURS}, vals AS (SELECT DISTINCT l, r FROM pairs),
        lw AS (SELECT l, r, unnest(regexp_extract_all(l, '\\w+')) AS w FROM vals),
        rw AS (SELECT l, r, unnest(regexp_extract_all(r, '\\w+')) AS w FROM vals),
        lc AS (SELECT l, r, w, count(*) AS n FROM lw GROUP BY ALL),
        rc AS (SELECT l, r, w, count(*) AS n FROM rw GROUP BY ALL),
        ln AS (SELECT l, r, sqrt(sum(n * n)) AS norm FROM lc GROUP BY ALL),
        rn AS (SELECT l, r, sqrt(sum(n * n)) AS norm FROM rc GROUP BY ALL),
        dot AS (SELECT l, r, sum(lc.n * rc.n) AS d FROM lc JOIN rc USING (l, r, w) GROUP BY ALL)
        SELECT p_partkey, round(coalesce(d, 0) / (ln.norm * rn.norm), 6) AS cosine_similarity,
          round(1 - coalesce(d, 0) / (ln.norm * rn.norm), 6) AS cosine_distance
        FROM pairs JOIN ln USING (l, r) JOIN rn USING (l, r) LEFT JOIN dot USING (l, r)""",
    "score_jaro_winkler": _by_pair(
        "round(jaro_winkler_similarity(l, r), 6) AS jaro_winkler_similarity, "
        "round(1 - jaro_winkler_similarity(l, r), 6) AS jaro_winkler_distance"
    ),
    "score_lcs": _by_value(
        f"{_lcs('l', 'r')}::INTEGER AS lcs_length",
        "lcs_length, (length(l) + length(r) - 2 * lcs_length)::INTEGER AS lcs_distance",
    ),
    "score_fuzzy": f"""WITH RECURSIVE {NEIGHBOURS}, vals AS (SELECT DISTINCT l, r FROM pairs),
        walk AS (
          SELECT l, r, 1 AS i, 0 AS score, 1 AS free, -1 AS prev FROM vals
          UNION ALL
          SELECT l, r, i + 1,
            CASE WHEN hit = 0 THEN score WHEN free - 1 + hit = prev + 1 THEN score + 3 ELSE score + 1 END,
            CASE WHEN hit = 0 THEN 0 ELSE free + hit END,
            CASE WHEN hit = 0 THEN prev ELSE free - 1 + hit END
          FROM (SELECT *, CASE WHEN free = 0 THEN 0
                  ELSE strpos(substr(lower(l), free), substr(lower(r), i, 1)) END AS hit
                FROM walk WHERE i <= length(r)))
        SELECT p_partkey, score::INTEGER AS fuzzy_subsequence_score
        FROM pairs JOIN walk USING (l, r) WHERE i = length(r) + 1""",
    "score_ratio": _by_value(f"{_ratio(_lcs('l', 'r'), 'l', 'r')} AS ratio", "ratio"),
    "score_partial": f"""WITH {NEIGHBOURS}, vals AS (
          SELECT DISTINCT l, r, CASE WHEN length(l) <= length(r) THEN l ELSE r END AS short,
            CASE WHEN length(l) <= length(r) THEN r ELSE l END AS long FROM pairs),
        windows AS (
          SELECT l, r, short, substr(long, s, length(short)) AS w
          FROM (SELECT *, unnest(range(1, length(long) - length(short) + 2)) AS s FROM vals)),
        scored AS (
          SELECT l, r, max({_ratio(_lcs('short', 'w'), 'short', 'w')}) AS partial_ratio FROM windows GROUP BY l, r)
        SELECT p_partkey, partial_ratio FROM pairs JOIN scored USING (l, r)""",
}

SORTED_WORDS = """, sorted AS (SELECT l, r,
    array_to_string(list_sort(list_filter(string_split(lower(regexp_replace(l, '[^A-Za-z0-9_]', ' ', 'g')), ' '),
      lambda t: t > '')), ' ') AS sl,
    array_to_string(list_sort(list_filter(string_split(lower(regexp_replace(r, '[^A-Za-z0-9_]', ' ', 'g')), ' '),
      lambda t: t > '')), ' ') AS sr FROM vals)"""
_TOKEN_SORT = f"""WITH {NEIGHBOURS}, vals AS (SELECT DISTINCT l, r FROM pairs){SORTED_WORDS},
    scored AS (SELECT l, r, {_ratio(_lcs('sl', 'sr'), 'sl', 'sr')} AS token_sort_ratio FROM sorted)
    SELECT p_partkey, token_sort_ratio FROM pairs JOIN scored USING (l, r)"""
ORACLES["score_token_sort"] = _TOKEN_SORT
ORACLES["score_minimum"] = f"{_TOKEN_SORT} WHERE token_sort_ratio >= 80"


# Record pairs of a block with their score, counted by the least ids of equal values.
_FOLDED = """value AS (SELECT {block}, {text} AS v, min({key}) AS profile FROM {table}
    WHERE {known} AND {text} IS NOT NULL GROUP BY ALL),
  one AS (SELECT t.{key} AS id, v.profile FROM {table} t JOIN value v ON {same} AND t.{text} = v.v),
  folded AS (
    SELECT {named}, least(x.profile, y.profile) AS profile1, greatest(x.profile, y.profile) AS profile2,
      count(*) AS pairs, round(max(score), 6) AS score
    FROM scored JOIN one x ON x.id = scored.a JOIN one y ON y.id = scored.b GROUP BY ALL)"""


def _folded(table: str, key: str, block: list[str], text: str) -> str:
    return _FOLDED.format(
        table=table,
        key=key,
        text=text,
        block=", ".join(block),
        known=" AND ".join(f"{b} IS NOT NULL" for b in block),
        same=" AND ".join(f"t.{b} = v.{b}" for b in block),
        named=", ".join(f"scored.{b}" for b in block),
    )


_DOCUMENT_WORDS = r"""word AS (
    SELECT doc_id, lang, source, w, count(*) AS n
    FROM (SELECT doc_id, lang, source, unnest(regexp_extract_all(text, '\w+')) AS w FROM documents) GROUP BY ALL)"""
_SAME_BLOCK = "a.lang = b.lang AND a.source = b.source AND a.doc_id < b.doc_id AND a.w = b.w"
ORACLES["similar_documents"] = f"""WITH {_DOCUMENT_WORDS}, size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY doc_id),
  shared AS (SELECT a.lang, a.source, a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM word a JOIN word b ON {_SAME_BLOCK} GROUP BY ALL),
  scored AS (
    SELECT lang, source, a, b, c::DOUBLE / (x.n + y.n - c) AS score
    FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE c::DOUBLE / (x.n + y.n - c) >= 0.8),
  {_folded('documents', 'doc_id', ['lang', 'source'], 'text')} SELECT * FROM folded"""
ORACLES["similar_word_counts"] = f"""WITH {_DOCUMENT_WORDS}, norm AS (SELECT doc_id, sqrt(sum(n * n)) AS n FROM word GROUP BY doc_id),
  shared AS (SELECT a.lang, a.source, a.doc_id AS a, b.doc_id AS b, sum(a.n * b.n) AS c FROM word a JOIN word b ON {_SAME_BLOCK} GROUP BY ALL),
  scored AS (
    SELECT lang, source, a, b, c / (x.n * y.n) AS score
    FROM shared JOIN norm x ON x.doc_id = a JOIN norm y ON y.doc_id = b WHERE c / (x.n * y.n) >= 0.9),
  {_folded('documents', 'doc_id', ['lang', 'source'], 'text')} SELECT * FROM folded"""
ORACLES["similar_part_names"] = f"""WITH scored AS (
    SELECT x.p_brand, x.p_partkey AS a, y.p_partkey AS b, jaccard(x.p_name, y.p_name) AS score
    FROM part x JOIN part y ON x.p_brand = y.p_brand AND x.p_partkey < y.p_partkey WHERE jaccard(x.p_name, y.p_name) >= 0.8),
  {_folded('part', 'p_partkey', ['p_brand'], 'p_name')} SELECT * FROM folded"""
ORACLES["score_minimums"] = f"""WITH {NEIGHBOURS}, vals AS (SELECT DISTINCT l, r FROM pairs),
    scored AS (SELECT l, r, {_lcs('l', 'r')}::INTEGER AS lcs_length, {_ratio(_lcs('l', 'r'), 'l', 'r')} AS ratio,
      jaro_winkler_similarity(l, r) AS jw FROM vals)
    SELECT p_partkey, ratio, round(jw, 6) AS jaro_winkler_similarity, lcs_length
    FROM pairs JOIN scored USING (l, r) WHERE ratio >= 60 AND jw >= 0.7 AND lcs_length >= 12"""


ORACLES["csv_line_breaks"] = """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name
    ELSE c_name || chr(10) || '"' || c_mktsegment || '",' || chr(10) END AS c_name, c_acctbal, c_mktsegment
  FROM customer WHERE c_custkey % 7 <> 0"""
ORACLES["monitor_windowed"] = """WITH span AS (
    SELECT time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS stop, count(*)::DOUBLE AS n,
      (count(*) FILTER (value IS NULL OR event_type = 'error'))::DOUBLE AS missing FROM events GROUP BY ALL),
  final AS (SELECT * FROM span WHERE stop <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events))
  SELECT strftime(stop, '%Y-%m-%d %H:%M:%S') AS window_end, 'ROW_COUNT' AS metric_name, n AS value FROM final
  UNION ALL SELECT strftime(stop, '%Y-%m-%d %H:%M:%S'), 'NULL_COUNT', missing FROM final"""
ORACLES["monitor_changes"] = f"""WITH {IDENTIFIERS}, held AS (
    SELECT * FROM (VALUES (1, 0), (1, 1), (2, 0), (2, 1), (2, 2), (3, 0), (3, 0), (3, 2), (4, 0), (4, 0), (4, 2), (5, 0), (5, 2))
      AS t(step, third)),
  seen AS (SELECT step, pesel FROM held JOIN people ON c_custkey % 3 = third)
  SELECT step::BIGINT AS step, 'ROW_COUNT' AS metric_name, count(*)::DOUBLE AS value FROM seen GROUP BY step
  UNION ALL SELECT step, 'INVALID_PESEL_COUNT', (count(*) FILTER {MALFORMED})::DOUBLE FROM seen GROUP BY step"""
ORACLES["metric_periods"] = f"""WITH RECURSIVE {IDENTIFIERS}, {MEASURED},
  times AS (SELECT * FROM (VALUES (0, 0), (1, 4), (2, 5), (3, 11), (4, 31)) AS t(round, minute)),
  fired AS (
    SELECT table_name, period, 0 AS round, 0 AS latest, true AS fires, 0 AS missed
    FROM (VALUES ('customer', 10), ('events', 5)) AS t(table_name, period)
    UNION ALL
    SELECT table_name, period, times.round, CASE WHEN minute - latest >= period THEN minute ELSE latest END,
      minute - latest >= period, (minute - latest) // period - 1
    FROM fired JOIN times ON times.round = fired.round + 1)
  SELECT round::BIGINT AS round, table_name, column_name, metric_name, value, missed::BIGINT AS missed
  FROM fired JOIN measured USING (table_name) WHERE fires"""

ORACLES["several_rules"] = f"""WITH {RECORDS}, kinds AS (SELECT *, split_part(address, ' ', 1) AS kind FROM rec),
  every AS (
    SELECT CASE WHEN a.fname = b.fname THEN 0 WHEN a.lname = b.lname THEN 1 ELSE 2 END AS rule,
      least(a.lname, b.lname) AS one, greatest(a.lname, b.lname) AS other,
      {_fuzzy('a.address', 'b.address')} AS address, {_fuzzy('a.lname', 'b.lname')} AS brands
    FROM kinds a JOIN kinds b ON a.cust_id < b.cust_id AND (a.fname = b.fname OR a.lname = b.lname OR a.kind = b.kind))
  SELECT rule, one, other, count(*) AS pairs, round(sum(address), 3) AS address FROM every
  WHERE address >= 0.5 AND brands >= 0.5 GROUP BY rule, one, other"""

_NATIONS = "nation ON {key} = n_nationkey"
_BORN = "DATE '1970-01-01' + ({key} % 9000)::INTEGER"
_MAIN = f"""ten AS (SELECT c_custkey AS k, {TEN} AS ten FROM customer),
  numbered AS (SELECT k, ten, {CHECK} AS digit FROM ten),
  marked AS (SELECT k, CASE k % 10 WHEN 0 THEN NULL WHEN 1 THEN '00000000000' WHEN 2 THEN ten || ((digit + 1) % 10)::VARCHAR WHEN 3 THEN ten
    WHEN 4 THEN 'A' || substr(ten, 2, 9) || digit::VARCHAR ELSE ten || digit::VARCHAR END AS pesel FROM numbered),
  main AS (
    SELECT pesel, n_name || '-' || c_custkey % 4 AS imie, c_name AS nazwisko, {_BORN.format(key='c_custkey')} AS born,
      n_name || ' ' || c_mktsegment AS city, ' ul. ' || n_name || ', 5' AS street, c_mktsegment AS grupa, c_nationkey AS tariff, c_acctbal
    FROM customer JOIN {_NATIONS.format(key='c_nationkey')} JOIN marked ON k = c_custkey)"""
_WEB = f"""tens AS (SELECT s_suppkey AS k, lpad(((s_suppkey + 7) * 7919 + 12345)::VARCHAR, 10, '0') AS ten FROM supplier),
  digit AS (SELECT k, ten, {CHECK} AS digit FROM tens),
  sign AS (SELECT k, CASE (k + 7) % 10 WHEN 0 THEN NULL WHEN 1 THEN '00000000000' WHEN 2 THEN ten || ((digit + 1) % 10)::VARCHAR WHEN 3 THEN ten
    WHEN 4 THEN 'A' || substr(ten, 2, 9) || digit::VARCHAR ELSE ten || digit::VARCHAR END AS pesel FROM digit),
  web AS (
    SELECT pesel, n_name || '-' || s_suppkey % 4 AS imie, replace(s_name, 'Supplier', 'Customer') AS nazwisko,
      {_BORN.format(key='s_suppkey')} AS born, n_name || ' BUILDING' AS city, 'shop' || s_suppkey || '@example.org' AS mail
    FROM supplier JOIN {_NATIONS.format(key='s_nationkey')} JOIN sign ON k = s_suppkey)"""
_NONE = "NULL::VARCHAR AS {0}"
ORACLES["customer_files"] = f"""WITH {_MAIN}, {_WEB}
  SELECT pesel AS PESEL, imie AS IMIE, nazwisko AS NAZWISKO, NULL AS PLEC, born AS DATA_URODZENIA, city AS MIASTO_ZAMELDOWANIA,
    street AS ULICA_ZAMIESZKANIA, NULL AS NUMER_DOMU, grupa AS GRUPA, tariff AS ID_TARYFY, NULL AS TEL_USED, NULL AS TEL_SOLD,
    NULL AS CZAS_W_MIESIACU, c_acctbal::DECIMAL(10,2) AS CZAS_DZISIAJ, NULL AS STATUS, NULL AS LICZBA_PUNKTOW, NULL AS PESEL_RC,
    NULL AS PESEL_GENDER, NULL AS OSOBA, NULL AS KOD_POCZTOWY, NULL AS E_MAIL, 'BAZA' AS SOURCE_SYSTEM FROM main
  UNION ALL SELECT pesel, imie, nazwisko, NULL, born, city, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
    NULL, NULL, NULL, mail, 'WWW' FROM web"""
_LAST, _TOWN = ("a.nazwisko", "b.nazwisko"), ("a.city", "b.city")
ORACLES["customer_file_links"] = f"""WITH {_MAIN}, {_WEB}, every AS (
    SELECT imie, nazwisko, city FROM main UNION ALL SELECT imie, nazwisko, city FROM web),
  people AS (SELECT row_number() OVER () AS k, {_std('imie')} AS imie, {_std('nazwisko')} AS nazwisko, {_std('city')} AS city FROM every),
  scored AS (SELECT a.imie, {_fuzzy(*_LAST)} AS lname_fuzzy, {_fuzzy(*_TOWN)} AS address_fuzzy
    FROM people a JOIN people b ON a.imie = b.imie AND a.k < b.k)
  SELECT imie AS IMIE, count(*) AS pairs, round(sum(lname_fuzzy), 3) AS lname_fuzzy, round(sum(address_fuzzy), 3) AS address_fuzzy
  FROM scored WHERE lname_fuzzy >= 0.4 AND address_fuzzy >= 0.4 GROUP BY imie"""
ORACLES["sql_alias_reuse"] = f"""WITH l AS (SELECT p_partkey, {_std("p_name || '; ' || p_brand")} AS label FROM part)
  SELECT p_partkey, label, length(label)::INTEGER AS size, label || ' ' || length(label) AS both FROM l"""
ORACLES["sql_pipes"] = f"""SELECT {_std('p_brand')} AS brand, count(*) AS parts, max(p_size) AS largest FROM part
  WHERE p_size > 10 GROUP BY 1 HAVING count(*) > 1"""
ORACLES["sql_variables"] = f"""WITH named AS (SELECT DISTINCT p_name, 'small ring' AS wanted FROM part),
  scored AS (SELECT p_name, round(jaccard(p_name, wanted), 6) AS jaccard, levenshtein(p_name, wanted)::INTEGER AS edits,
    {_lcs('p_name', 'wanted')}::INTEGER AS common FROM named)
  SELECT p_partkey, jaccard, edits, common FROM part JOIN scored USING (p_name)"""
ORACLES["capped_samples"] = f"SELECT * FROM ({ORACLES['build_samples']}) ORDER BY cust_key::BIGINT LIMIT 50"
ORACLES["soundex_folded"] = f"""WITH n AS (SELECT p_partkey, {_soundex('upper(p_name)')} AS folded,
    left(translate(upper(p_name), 'ACELNOSZ', 'ĄĆĘŁŃÓŚŻ'), 1) BETWEEN 'A' AND 'Z' AS plain_start FROM part),
  told AS (SELECT p_partkey, folded, translate(upper(p_name), 'ACELNOSZ', 'ĄĆĘŁŃÓŚŻ') AS polish FROM n JOIN part USING (p_partkey))
  SELECT p_partkey, folded, CASE WHEN regexp_matches(polish, '^[A-Z]') THEN {_soundex("regexp_replace(polish, '[^A-Z ]', '', 'g')")} = folded
    ELSE polish = folded END AS same, 1.0::DOUBLE AS score FROM told"""
ORACLES["score_foreign_words"] = f"""WITH words AS (
    SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS w FROM documents)
    WHERE regexp_full_match(w, '[a-zà-ÿ]{{2,16}}') AND regexp_matches(w, '[à-ÿ]')),
  pairs AS (SELECT word, {_std("replace(word, 'ß', 'ss')")} AS standard FROM words),
  held AS (SELECT *, CASE WHEN length(word) <= length(standard) THEN word ELSE standard END AS short,
    CASE WHEN length(word) <= length(standard) THEN standard ELSE word END AS long FROM pairs),
  common AS (SELECT *, CASE WHEN length(standard) > 0 THEN {_lcs('word', 'standard')} ELSE 0 END::INTEGER AS lcs_length FROM held)
  SELECT word, standard, lcs_length, (length(word) + length(standard) - 2 * lcs_length)::INTEGER AS lcs_distance,
    round_even(100.0 * (2.0 * lcs_length::DOUBLE / (length(word) + length(standard))::DOUBLE), 0)::INTEGER AS ratio,
    CASE WHEN length(short) = 0 THEN 0 ELSE list_max(list_transform(range(1, length(long) - length(short) + 2), lambda s:
      round_even(100.0 * ({_lcs('short', 'substr(long, s, length(short))')})::DOUBLE / length(short), 0)::INTEGER)) END AS partial_ratio FROM common"""
