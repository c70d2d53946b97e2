"""The queries of ``queries.py`` in DuckDB SQL."""

from __future__ import annotations

FILINGS = """filings AS (
  SELECT o_orderkey AS k,
         lpad(c_custkey::VARCHAR, greatest(8, length(c_custkey::VARCHAR))::INT, '0') AS corp_code,
         c_name AS corp_name,
         CASE WHEN c_acctbal < 0 THEN ''
              ELSE lpad(c_custkey::VARCHAR, greatest(6, length(c_custkey::VARCHAR))::INT, '0') END AS stock_code,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Y' WHEN 'BUILDING' THEN 'K' WHEN 'FURNITURE' THEN 'N' ELSE 'E' END AS corp_cls,
         o_orderpriority AS report_nm,
         strftime(o_orderdate, '%Y%m%d')
           || lpad(o_orderkey::VARCHAR, greatest(6, length(o_orderkey::VARCHAR))::INT, '0') AS rcept_no,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE c_name END AS flr_nm,
         strftime(o_orderdate, '%Y%m%d') AS rcept_dt,
         CASE WHEN o_orderstatus = 'O' THEN '' ELSE o_orderstatus END AS rm
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

PAGES = FILINGS + """,
listed AS (SELECT rcept_dt AS date, CAST(k // 10000 + 1 AS INT) AS page_no, count(*) AS n FROM filings GROUP BY ALL),
marked AS (
  SELECT date, page_no, n, right(date, 2)::INT AS day, (right(date, 2)::INT * 31 + page_no) % 17 AS mark,
         max(page_no) OVER (PARTITION BY date) AS n_pages, sum(n) OVER (PARTITION BY date) AS n_total
  FROM listed),
pages_in AS (
  SELECT date, page_no,
         CASE mark WHEN 0 THEN '020' WHEN 1 THEN '013' WHEN 2 THEN '800' WHEN 3 THEN '010' ELSE '000' END AS status,
         CASE WHEN mark > 3 AND (day * 7 + page_no) % 19 <> 0 THEN n ELSE 0 END AS n_items,
         CASE WHEN day = 27 THEN 'null' ELSE (n_pages - CASE WHEN day % 5 = 0 THEN 1 ELSE 0 END)::VARCHAR END AS said,
         TRY_CAST(said AS BIGINT) AS total_page,
         n_total::BIGINT AS total_count
  FROM marked),
ordered AS (
  SELECT *,
         row_number() OVER (PARTITION BY date ORDER BY page_no) AS rn,
         sum(CASE WHEN status <> '000' OR (n_items = 0 AND page_no > 1) THEN 1 ELSE 0 END)
           OVER (PARTITION BY date ORDER BY page_no) AS bad,
         max(CASE WHEN page_no = 1 AND status = '000' THEN total_page END) OVER (PARTITION BY date) AS tp,
         bool_or(page_no = 1 AND status = '000' AND said = 'null') OVER (PARTITION BY date) AS rejected
  FROM pages_in),
counted AS (
  SELECT * FROM ordered WHERE bad = 0 AND NOT rejected AND rn = page_no AND page_no <= greatest(coalesce(tp, 1), 1))"""

ATTEMPTS = """attempts AS (
  SELECT strftime(ts, '%Y%m%d') || lpad(user_id::VARCHAR, greatest(6, length(user_id::VARCHAR))::INT, '0') AS rcept_no,
         ts AS attempt_ts, event_id AS seq, event_type, value,
         CASE event_type WHEN 'purchase' THEN 'OK' WHEN 'signup' THEN 'SKIP' ELSE 'FAIL' END AS kind
  FROM events)"""

STATE = ATTEMPTS + """,
running AS (
  SELECT *, sum(CASE WHEN kind = 'FAIL' THEN 1 ELSE 0 END)
              OVER (PARTITION BY rcept_no ORDER BY attempt_ts, seq) AS nf
  FROM attempts),
termed AS (
  SELECT *, CASE WHEN kind <> 'FAIL' THEN kind WHEN nf = 3 THEN 'PERM' END AS term FROM running),
before AS (
  SELECT *, count(term) OVER (PARTITION BY rcept_no ORDER BY attempt_ts, seq
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
  FROM termed),
state AS (
  SELECT rcept_no, max(term) AS term, sum(CASE WHEN kind = 'FAIL' THEN 1 ELSE 0 END)::BIGINT AS fails
  FROM before WHERE prior = 0 GROUP BY rcept_no)"""

NUMBERED = ATTEMPTS + """,
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY rcept_no ORDER BY attempt_ts, seq) AS attempt_no FROM attempts)"""

LEDGER = ATTEMPTS + """,
ledger AS (
  SELECT rcept_no, attempt_ts, seq,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'signup' THEN 'SKIPPED_TOO_SMALL'
                         WHEN 'view' THEN 'SKIPPED_EXISTS' ELSE 'FAILED' END AS outcome,
         CASE WHEN event_type NOT IN ('purchase', 'view') THEN event_type || ' at ' || value::VARCHAR END AS reason
  FROM attempts)"""

MESSAGES = FILINGS + """,
messages AS (
  SELECT corp_code, corp_name, nullif(stock_code, '') AS stock_code, corp_cls, report_nm, rcept_no,
         nullif(flr_nm, '') AS flr_nm, rcept_dt, nullif(rm, '') AS rm,
         rcept_dt || '/' || rcept_no || CASE k % 3 WHEN 0 THEN '.html' WHEN 1 THEN '.xml' ELSE '' END AS object_key,
         CASE k % 3 WHEN 0 THEN 'text/html; charset=UTF-8' WHEN 1 THEN 'application/xml; charset=UTF-8'
                    ELSE 'application/octet-stream' END AS content_type,
         k * 37 % 5000 + 200 AS file_size,
         '20020101' AS polling_date
  FROM filings)"""

UNTIDY = MESSAGES + """,
tidy AS (
  SELECT *, file_size % 7 AS form, coalesce(stock_code, '') AS stock,
         CASE file_size % 7
           WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN '29 Dec'
           ELSE left(rcept_dt, 4) || '-' || substr(rcept_dt, 5, 2) || '-' || substr(rcept_dt, 7, 2) || 'T00:00:00Z'
         END AS iso,
         CASE WHEN file_size % 7 = 1
              THEN 'unconverted data remains: 32' END AS date_error
  FROM messages)"""

HEALTH = """last AS (
  SELECT user_id AS component, max(CASE WHEN event_type = 'purchase' THEN (ts, event_id) END) AS last
  FROM events GROUP BY 1),
health AS (
  SELECT component, any_value(last)[1] AS last_success,
         count(*) FILTER (WHERE event_type <> 'purchase' AND (last IS NULL OR (ts, event_id) > last)) AS consecutive_failures
  FROM events JOIN last ON user_id = component GROUP BY component),
checks AS (
  SELECT component, strftime(last_success, '%Y-%m-%d %H:%M:%S.%f') AS last_success, consecutive_failures,
         CASE WHEN last_success IS NULL THEN 'degraded' WHEN consecutive_failures > 5 THEN 'unhealthy'
              WHEN consecutive_failures > 0 THEN 'degraded' ELSE 'healthy' END AS status,
         CASE WHEN last_success IS NULL THEN 'No successful API call yet'
              WHEN consecutive_failures > 5 THEN 'Too many consecutive failures: ' || consecutive_failures
              WHEN consecutive_failures > 0 THEN 'Recent failures: ' || consecutive_failures
              ELSE 'Last success: ' || strftime(last_success, '%Y-%m-%dT%H:%M:%S.%f') END AS message
  FROM health)"""

WRAPPED = """wrapped AS (
  SELECT doc_id, doc_id % 3 AS k, text,
         CASE doc_id % 3 WHEN 0 THEN '<html><head></head><body>' || text || '</body></html>'
                         WHEN 1 THEN '<?xml version=''1.0''?><doc>' || text || '</doc>' ELSE text END AS body
  FROM documents)"""

ARCHIVES = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS j
  FROM documents),
members AS (
  SELECT doc_id, j,
         CASE WHEN doc_id % 3 = 2 AND j % 4 = 0 THEN 1 WHEN doc_id % 3 >= 1 AND j % 4 = 1 THEN 2 ELSE 3 END AS rank,
         CASE WHEN doc_id % 3 = 2 AND j % 4 = 0 THEN '<html><body>' || line || '</body></html>'
              WHEN doc_id % 3 >= 1 AND j % 4 = 1 THEN '<doc><p>' || line || '</p></doc>' ELSE line END AS data
  FROM lines),
totals AS (
  SELECT doc_id, count(*) AS n_files, sum(strlen(data))::BIGINT AS total_bytes FROM members GROUP BY doc_id),
best AS (
  SELECT doc_id, rank, j, data FROM members
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank, strlen(data) DESC, j) = 1),
normal AS (
  SELECT doc_id, n_files, total_bytes, rank, j,
         CASE rank WHEN 1 THEN '<meta charset="UTF-8">' || chr(10) || data
                   WHEN 2 THEN '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || data ELSE data END AS body,
         CASE rank WHEN 1 THEN '.html' WHEN 2 THEN '.xml' ELSE '' END AS ext,
         CASE rank WHEN 1 THEN 'text/html; charset=UTF-8' WHEN 2 THEN 'application/xml; charset=UTF-8'
                   ELSE 'application/octet-stream' END AS content_type,
         CASE WHEN rank < 3 THEN 'utf-8-sig' END AS used_enc,
         CASE rank WHEN 1 THEN 'html' WHEN 2 THEN 'xml' ELSE 'bin' END AS kind
  FROM totals JOIN best USING (doc_id))"""

DECLARING = """declaring AS (
  SELECT page_id,
         CASE WHEN page_id % 6 = 5
              THEN '<?xml version="1.0" encoding="Windows-949"?><doc>' || length(html) || '</doc>'
              ELSE replace(html, '<meta charset="utf-8">', CASE page_id % 6
                WHEN 1 THEN '<meta http-equiv="Content-Type" content="text/html; charset=EUC_KR">'
                WHEN 2 THEN '<META name=x CHARSET=''KS_C_5601-1987''>'
                WHEN 3 THEN ''
                WHEN 4 THEN '<meta charset=UTF8>'
                ELSE '<meta charset="utf-8">' END) END AS text
  FROM pages)"""

URL = "'https://dart.fss.or.kr/dsaf001/main.do?rcpNo='"
NO_DOCUMENT = "'Failed to download document from DART API.'"

ORACLE = {
    "filing_parse": f"""
WITH {FILINGS}
SELECT corp_code, corp_name, nullif(stock_code, '') AS stock_code, corp_cls, report_nm, rcept_no,
       nullif(flr_nm, '') AS flr_nm, rcept_dt, nullif(rm, '') AS rm, {URL} || rcept_no AS url
FROM filings WHERE k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0""",
    "filing_quarantine": f"""
WITH {FILINGS}
SELECT k, rcept_no,
       CASE WHEN k % 7 = 0 THEN 'Required key ''corp_name'' is missing.'
            WHEN k % 11 = 0 THEN 'Field ''corp_cls'' must be a string.'
            ELSE 'Field ''report_nm'' must be a string.' END AS reject_reason
FROM filings WHERE k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0""",
    "scan_predicates": f"""
WITH {FILINGS}
SELECT rcept_dt, count(*) AS n, CAST(ceil(count(*) / 100.0) AS INT) AS pages_of_100,
       CAST(ceil(count(*) / 100.0) AS INT) AS pages_of_250, CAST(ceil(count(*) / 2.0) AS INT) AS pages_of_2
FROM filings WHERE corp_cls = 'K' GROUP BY rcept_dt""",
    "page_prefix": f"""
WITH {PAGES}
SELECT date, page_no, n_items::INT AS n_items, said AS total_page_text FROM counted""",
    "page_routing": f"""
WITH {PAGES}
SELECT status,
       CASE status WHEN '000' THEN 'ok' WHEN '010' THEN 'unregistered key' WHEN '013' THEN 'no data'
                   WHEN '020' THEN 'request limit exceeded' ELSE 'maintenance' END AS meaning,
       CASE status WHEN '000' THEN 'accept' WHEN '010' THEN 'key_error' WHEN '013' THEN 'no_data'
                   WHEN '020' THEN 'rate_limited' ELSE 'maintenance' END AS page_action,
       CASE status WHEN '010' THEN 300 WHEN '020' THEN 3600 WHEN '800' THEN 300 ELSE 0 END AS wait_s,
       count(*) AS pages, sum(n_items)::BIGINT AS items
FROM pages_in GROUP BY ALL""",
    "day_totals": f"""
WITH {PAGES}
SELECT p.date,
       max(CASE WHEN p.page_no = 1 AND p.status = '000' THEN greatest(p.total_page, 1) END)::BIGINT AS declared_pages,
       max(CASE WHEN p.page_no = 1 AND p.status = '000' THEN p.total_count END) AS declared_count,
       count(c.page_no) AS pages_seen, coalesce(sum(c.n_items), 0)::BIGINT AS items_seen
FROM pages_in p LEFT JOIN counted c ON p.date = c.date AND p.page_no = c.page_no
GROUP BY p.date""",
    "new_filings": f"""
WITH {FILINGS},
stored AS (SELECT rcept_dt, rcept_no FROM filings WHERE rm = 'F'),
known AS (SELECT rcept_no FROM filings WHERE corp_cls = 'Y' UNION SELECT rcept_no FROM filings WHERE report_nm = '1-URGENT')
SELECT rcept_no, rcept_dt, CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END::BIGINT AS n_listed
FROM filings f
WHERE NOT EXISTS (SELECT 1 FROM known n WHERE n.rcept_no = f.rcept_no)
  AND NOT EXISTS (SELECT 1 FROM stored s WHERE s.rcept_no = f.rcept_no AND s.rcept_dt = f.rcept_dt)""",
    "stored_filings": f"""
WITH {FILINGS}
SELECT rcept_dt, rm = 'F' AS is_stored, count(*) AS n FROM filings GROUP BY ALL""",
    "known_ids": f"""
WITH {ATTEMPTS}
SELECT left(rcept_no, 8) AS day, count(DISTINCT rcept_no) AS ids FROM attempts GROUP BY 1""",
    "document_join": f"""
WITH {FILINGS}
SELECT rcept_no,
       CASE WHEN doc_id IS NULL THEN 'missing' WHEN doc_id % 2 = 0 THEN 'archive' ELSE 'other' END AS state,
       (strlen(text) + CASE WHEN doc_id % 2 = 0 THEN 4 ELSE 0 END)::INT AS length
FROM filings LEFT JOIN documents ON k = doc_id""",
    "error_answers": f"""
SELECT CASE WHEN doc_id % 16 = 0 THEN 'DART API Error [010]: none'
            WHEN doc_id % 8 = 0 THEN {NO_DOCUMENT} END AS download_error, count(*) AS n
FROM documents GROUP BY 1""",
    "doc_error_routing": """
WITH a AS (
  SELECT event_id,
         CASE WHEN event_id % 10 <> 0 THEN
           ['000','010','011','012','013','014','020','021','100','101','800','900','901'][event_id % 13 + 1] END AS status,
         CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'Unknown error' ELSE event_type END AS message
  FROM events)
SELECT event_id, status, message,
       CASE WHEN status IS NULL THEN 'unreadable' WHEN status IN ('013', '014', '100') THEN 'no_retry'
            WHEN status IN ('010', '011', '901') THEN 'critical' ELSE 'none' END AS doc_action
FROM a""",
    "message_projection": f"WITH {MESSAGES} SELECT * FROM messages",
    "publish_roundtrip": f"WITH {MESSAGES} SELECT * FROM messages",
    "upsert_payload": f"""
WITH {UNTIDY}
SELECT rcept_no, report_nm AS "reportName", corp_code AS "corpCode", corp_name AS "corpName", corp_cls AS "corpCls",
       flr_nm AS "flrName", iso AS "receptionDate", stock AS "stockCode", rm AS remark,
       object_key AS "minioObjectName", content_type AS "contentType", file_size AS "fileSize", date_error,
       '{{"reportName":"' || report_nm || '","corpCode":"' || corp_code || '","corpName":"' || corp_name
         || '","corpCls":"' || corp_cls || '","flrName":' || coalesce('"' || flr_nm || '"', 'null')
         || ',"receptionDate":' || coalesce('"' || iso || '"', 'null') || ',"stockCode":"' || stock || '"'
         || coalesce(',"remark":"' || rm || '"', '') || ',"minioObjectName":"' || object_key
         || '","contentType":"' || content_type || '","fileSize":' || file_size || '}}' AS body
FROM tidy""",
    "task_results": f"""
WITH {UNTIDY},
answered AS (SELECT *, date_error IS NULL AND file_size % 5 = 0 AS refused, date_error IS NULL AND file_size % 5 > 1 AS done FROM tidy)
SELECT rcept_no, CASE WHEN done THEN 'success' ELSE 'error' END AS status,
       CASE WHEN date_error IS NOT NULL THEN 'unexpected_error' WHEN refused THEN 'client_error' END AS error_type,
       CASE WHEN refused THEN repeat('no ' || rcept_no || '; ', 20) ELSE date_error END AS error_message,
       CASE WHEN done THEN corp_code END AS corp_code,
       CASE WHEN done THEN chr(9) || ' ' || corp_name || chr(12288) END AS corp_name,
       CASE WHEN done THEN object_key END AS object_key
FROM answered WHERE date_error IS NOT NULL OR refused OR done""",
    "reception_dates": f"""
WITH {UNTIDY}
SELECT iso AS reception_date, date_error AS refused, count(*) AS n FROM tidy GROUP BY ALL""",
    "object_store_write": f"""
WITH {WRAPPED},
done AS (
  SELECT lpad(doc_id::VARCHAR, 10, '0') AS rcept_no, '200201' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS rcept_dt, k,
         CASE k WHEN 0 THEN replace(body, '<html><head>', '<html><head>' || chr(10) || '<meta charset="UTF-8">')
                WHEN 1 THEN '<?xml version="1.0" encoding="UTF-8"?><doc>' || text || '</doc>' ELSE body END AS out
  FROM wrapped)
SELECT rcept_no, rcept_dt,
       rcept_dt || '/' || rcept_no || CASE k WHEN 0 THEN '.html' WHEN 1 THEN '.xml' ELSE '' END AS object_key,
       CASE k WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/xml; charset=UTF-8' ELSE 'application/octet-stream' END AS content_type,
       strlen(out) AS file_size, md5(out) AS body_md5
FROM done WHERE strlen(out) >= 200""",
    "response_routing": """
WITH r AS (
  SELECT event_id, event_type, event_id % 4 + 1 AS attempt_no, repeat(props, 30) AS response FROM events)
SELECT event_id,
       CASE WHEN event_type IN ('purchase', 'signup') THEN 'success' WHEN event_type = 'view' THEN 'error'
            WHEN attempt_no < 3 THEN 'retry' ELSE 'exhausted' END AS status,
       CASE WHEN event_type = 'view' THEN 'client_error' END AS error_type,
       CASE WHEN event_type = 'view' THEN response END AS error_message,
       CASE WHEN event_type = 'view' THEN left(response, 200) END AS logged,
       CASE WHEN event_type NOT IN ('purchase', 'signup', 'view') AND attempt_no < 3
            THEN pow(2, attempt_no - 1) * 0.5 END::DOUBLE AS wait_s
FROM r""",
    "url_masking": """
SELECT c_custkey,
       CASE c_custkey % 4 WHEN 0 THEN 'amqp://' || c_name || ':***@mq:5672/' WHEN 1 THEN 'http://mq:5672/' || c_name
                          WHEN 2 THEN 'amqp://' || c_name || '@mq' ELSE '' END AS masked,
       left(c_name, 8) || '...' AS key
FROM customer""",
    "content_type_default": f"""
WITH {FILINGS}
SELECT CASE WHEN k % 9 = 0 THEN 'application/octet-stream'
            ELSE ['text/html', 'text/xml', 'application/zip', 'text/plain', 'application/pdf', 'application/json',
                  'application/octet-stream'][k % 7 + 1] END AS content_type, count(*) AS n
FROM filings GROUP BY 1""",
    "upsert_latest": f"""
WITH {ATTEMPTS}
SELECT substr(rcept_no, 9) AS rcept_no, seq, event_type, value FROM attempts
QUALIFY row_number() OVER (PARTITION BY substr(rcept_no, 9) ORDER BY attempt_ts DESC, seq DESC) = 1""",
    "retry_state": f"WITH {STATE} SELECT * FROM state",
    "stream_retry": f"WITH {STATE} SELECT * FROM state",
    "retry_stats": f"""
WITH {STATE}
SELECT count(term) AS processed_count, count(*) FILTER (WHERE term = 'OK') AS success_count,
       count(*) FILTER (WHERE term = 'SKIP') AS skip_count, sum(fails)::BIGINT AS error_count,
       count(*) FILTER (WHERE fails > 0 AND (term IS NULL OR term = 'SKIP')) AS pending_retry_count,
       count(*) FILTER (WHERE term = 'PERM') AS permanently_failed_count
FROM state""",
    "attempt_numbers": f"""
WITH {NUMBERED} SELECT seq, rcept_no, kind, attempt_no::INT AS attempt_no FROM numbered WHERE attempt_no <= 3""",
    "backoff_schedule": f"""
WITH {NUMBERED},
w AS (SELECT *, CASE WHEN attempt_no < 3 THEN (pow(2, attempt_no - 1) * 0.5)::DOUBLE END AS wait_s
      FROM numbered WHERE attempt_no <= 3 AND kind = 'FAIL')
SELECT seq, attempt_no::INT AS attempt_no, wait_s,
       strftime(attempt_ts + to_milliseconds((wait_s * 1000)::BIGINT), '%Y-%m-%d %H:%M:%S.%f') AS next_attempt_ts
FROM w""",
    "due_retries": f"""
WITH {STATE}
SELECT rcept_no,
       CASE WHEN fails > 0 AND (term IS NULL OR term = 'SKIP') THEN fails ELSE 0 END AS prior_fails,
       CASE WHEN fails > 0 AND term IS NULL THEN fails END AS due_fails
FROM state""",
    "failure_latest": f"""
WITH {LEDGER}
SELECT rcept_no, strftime(attempt_ts, '%Y-%m-%d %H:%M:%S.%f') AS recorded_at, reason AS failure_reason
FROM ledger WHERE reason IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY rcept_no ORDER BY attempt_ts DESC, seq DESC) = 1""",
    "outcome_counts": f"WITH {LEDGER} SELECT outcome, count(*) AS n FROM ledger GROUP BY 1",
    "sniff_kind": """
WITH shaped AS (
  SELECT doc_id, doc_id % 12 AS k,
         CASE doc_id % 12 WHEN 1 THEN '<html>' WHEN 2 THEN ' <!doctype' || chr(10) || 'HTML>'
           WHEN 3 THEN '<?xml version="1.0"?><r>' WHEN 4 THEN chr(10) || '<r><p>' WHEN 5 THEN '<r><div>'
           WHEN 7 THEN chr(65279) || '<?xml version=''1.0''?><r/>' WHEN 8 THEN '<div>a</div>' WHEN 9 THEN '<div>'
           WHEN 10 THEN '<div>' ELSE '' END AS head,
         CASE doc_id % 12 WHEN 6 THEN '<HEAD>' WHEN 9 THEN '</div><div>b</div>'
           WHEN 11 THEN '<meta name=x charset=utf-8>' ELSE '' END AS tail,
         CASE WHEN doc_id % 12 = 10 THEN '' ELSE text END AS body
  FROM documents),
whole AS (SELECT doc_id, k, head, body, head || body || tail AS data FROM shaped)
SELECT 'document ' || doc_id AS id,
       CASE WHEN regexp_matches(data, '(?is)<html[^>]*>|<!doctype\\s+html|<head[^>]*>|<meta[^>]*charset\\s*=') THEN 'html'
            WHEN regexp_matches(data, '^\\x{FEFF}?\\s*<\\?xml') THEN 'xml'
            WHEN k = 10 OR (k = 8 AND trim(body, ' ' || chr(9) || chr(10) || chr(13)) = '') THEN 'xml'
            WHEN regexp_matches(data, '^\\s*<') AND NOT regexp_matches(data, '(?i)<div') THEN 'xml'
            ELSE 'bin' END AS kind
FROM whole
UNION ALL
SELECT 'page ' || page_id, CASE WHEN regexp_matches(html, '(?is)<html[^>]*>') THEN 'html' ELSE 'bin' END FROM pages""",
    "declared_encoding": f"""
WITH {DECLARING},
found AS (
  SELECT page_id, lower(replace(coalesce(
           nullif(regexp_extract(text, '(?is)<\\?xml[^>]+encoding\\s*=\\s*["'']?([a-zA-Z0-9._-]+)', 1), ''),
           nullif(regexp_extract(text, '(?is)<meta[^>]+charset\\s*=\\s*["'']?([a-zA-Z0-9._-]+)', 1), '')), '_', '-')) AS name
  FROM declaring),
named AS (
  SELECT page_id, CASE WHEN name = 'utf8' THEN 'utf-8' WHEN name IN ('ks-c-5601-1987', 'windows-949') THEN 'cp949'
                       ELSE name END AS declared
  FROM found)
SELECT page_id, declared,
       CASE declared WHEN 'utf-8' THEN 'UTF-8' WHEN 'cp949' THEN 'MS949' WHEN 'euc-kr' THEN 'EUC-KR' END AS charset
FROM named""",
    "charset_ladder": """
WITH d AS (
  SELECT doc_id, doc_id % 5 AS k,
         CASE WHEN doc_id % 5 >= 3
              THEN regexp_replace(translate(text, 'aeiou', '가나다라마'), '[^\\x{0}-\\x{7F}\\x{AC00}-\\x{D7A3}]', '?', 'g')
              ELSE text END AS out
  FROM documents)
SELECT doc_id,
       CASE k WHEN 0 THEN 'iso-8859-1' WHEN 1 THEN 'windows-1252' WHEN 2 THEN 'utf-8-sig' WHEN 4 THEN 'euc-kr'
              ELSE CASE WHEN regexp_matches(out, '[가나다라마]') THEN 'cp949' ELSE 'utf-8-sig' END END AS used_enc,
       length(out)::INT AS n_chars, md5(out) AS text_md5
FROM d""",
    "utf8_validity": """
SELECT doc_id, doc_id % 2 = 0 OR regexp_full_match(text, '(?s)[\\x{0}-\\x{7F}]*') AS valid FROM documents""",
    "html_rewrite": f"""
WITH {DECLARING},
shaped AS (
  SELECT page_id,
         CASE page_id % 4 WHEN 1 THEN regexp_replace(text, '(?i)</?head[^>]*>', '', 'g')
                          WHEN 2 THEN regexp_replace(text, '(?i)<!doctype[^>]*>|</?head[^>]*>', '', 'g')
                          ELSE text END AS t
  FROM declaring),
done AS (
  SELECT page_id,
         CASE WHEN page_id % 6 = 5 THEN regexp_replace(t, '^<\\?xml[^>]*>', '<?xml version="1.0" encoding="UTF-8"?>')
              WHEN regexp_matches(t, '(?is)<meta[^>]+charset\\s*=') THEN
                regexp_replace(t, '(?is)<meta[^>]+charset\\s*=\\s*["'']?[a-zA-Z0-9._-]+[^>]*>', '<meta charset="UTF-8">', 'g')
              WHEN regexp_matches(t, '(?is)<head[^>]*>') THEN
                regexp_replace(t, '(?is)(<head[^>]*>)', '\\1' || chr(10) || '<meta charset="UTF-8">')
              WHEN regexp_matches(t, '(?is)^\\s*<!doctype[^>]*>') THEN
                regexp_replace(t, '(?is)^(\\s*<!doctype[^>]*>\\s*)', '\\1' || chr(10) || '<meta charset="UTF-8">')
              ELSE '<meta charset="UTF-8">' || chr(10) || t END AS out
  FROM shaped)
SELECT page_id, length(out)::INT AS n_chars, md5(out) AS text_md5 FROM done""",
    "xml_rewrite": f"""
WITH {WRAPPED},
done AS (
  SELECT doc_id, CASE k WHEN 1 THEN '<?xml version="1.0" encoding="UTF-8"?><doc>' || text || '</doc>'
                        ELSE '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || body END AS out
  FROM wrapped)
SELECT doc_id, strlen(out)::INT AS n_bytes, md5(out) AS text_md5 FROM done""",
    "safe_name": """
WITH names AS (
  SELECT url AS name FROM pages
  UNION ALL
  SELECT 'dir.x/' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ' .tar.gz' ELSE 'é' END FROM customer),
stems AS (
  SELECT name, regexp_replace(trim(regexp_extract(name, '([^/]*)$', 1)), '^(.*[^.].*)\\.[^.]*$', '\\1') AS stem FROM names)
SELECT name, coalesce(nullif(trim(regexp_replace(
         regexp_replace(strip_accents(stem), '[^\\x{0}-\\x{7F}]+', '', 'g'), '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), ''),
         'document') AS safe
FROM stems""",
    "archive_best": f"""
WITH {ARCHIVES}
SELECT doc_id,
       CASE WHEN n_files > 200 THEN 'application/octet-stream' ELSE content_type END AS content_type,
       lpad(doc_id::VARCHAR, 10, '0') || CASE WHEN n_files > 200 THEN '.zip' ELSE ext END AS filename,
       CASE WHEN n_files <= 200 THEN used_enc END AS used_enc,
       CASE WHEN n_files > 200 THEN 'ZIP(failed: Too many files in ZIP: ' || n_files || ' (max: 200))'
            ELSE 'ZIP(' || n_files || ' files) -> ''part_' || j || ''' (' || kind || ')'
                 || CASE WHEN rank < 3 THEN ' [enc: utf-8-sig]' ELSE '' END END AS summary,
       CASE WHEN n_files <= 200 THEN strlen(body) END::INT AS n_bytes,
       CASE WHEN n_files <= 200 THEN md5(body) END AS body_md5
FROM normal""",
    "archive_guard": f"""
WITH {ARCHIVES}
SELECT doc_id, n_files::INT AS n_files, total_bytes,
       CASE WHEN n_files > 20 THEN 'Too many files in ZIP: ' || n_files || ' (max: 20)'
            WHEN total_bytes > 5000 THEN 'ZIP too large: ' || total_bytes || ' bytes (max: 5000)' END AS failure,
       CASE WHEN n_files <= 20 AND total_bytes <= 5000 THEN 'part_' || j END AS best
FROM normal""",
    "archive_names": """
SELECT doc_id, '사업보고서_' || doc_id || '.txt' AS name, strlen(text) AS size FROM documents""",
    "size_gate": """
SELECT doc_id, strlen(text) AS file_size,
       CASE WHEN strlen(text) < 2000 THEN 'Processed file too small (' || strlen(text) || ' bytes).' END AS skip_reason
FROM documents""",
    "processing_summary": f"""
WITH {FILINGS},
s AS (
  SELECT *, CASE k % 4 WHEN 0 THEN 'Detected as ''bin''' WHEN 1 THEN 'ZIP(failed: Empty ZIP file)'
                       WHEN 2 THEN 'ZIP(' || (k % 9 + 1) || ' files) -> ''m' || k || '.xml'' (xml) [enc: cp949]'
                       ELSE 'HTML [enc: cp949]' END AS summary,
         rcept_dt || CASE WHEN k % 4 = 0 OR rcept_dt = '20020101' THEN '' ELSE ' (Polled on 20020101)' END AS dates
  FROM filings)
SELECT rcept_no, summary,
       'Processed | ' || dates || repeat(' ', greatest(0, 30 - length(dates))::INT)
         || ' | [' || corp_name || repeat(' ', greatest(0, 15 - length(corp_name))::INT)
         || '] | ' || report_nm || repeat(' ', greatest(0, 50 - length(report_nm))::INT)
         || ' | Saved as ''' || rcept_no || '.html'' (' || summary || ')' AS line,
       left(report_nm, 5) AS short_name
FROM s""",
    "consecutive_failures": f"WITH {HEALTH} SELECT * FROM checks",
    "health_rollup": f"""
WITH {HEALTH}
SELECT component // 10 AS service,
       CASE WHEN bool_or(status = 'unhealthy') THEN 'unhealthy' WHEN bool_or(status = 'degraded') THEN 'degraded'
            ELSE 'healthy' END AS status,
       NOT bool_or(status = 'unhealthy') AS ready, count(*) AS checks
FROM checks GROUP BY 1""",
    "poll_metrics": """
SELECT strftime(ts, '%Y%m%d') AS day, count(*) FILTER (WHERE event_type = 'view') AS polls,
       count(*) FILTER (WHERE event_type = 'purchase') AS processed_count,
       count(*) FILTER (WHERE event_type = 'error') AS error_count,
       strftime(max(ts) FILTER (WHERE event_type = 'view'), '%Y-%m-%d %H:%M:%S.%f') AS last_poll,
       round(max(value / 7), 2) AS max_latency_ms
FROM events GROUP BY 1""",
    "stream_dedup": f"WITH {ATTEMPTS} SELECT DISTINCT rcept_no FROM attempts",
    "stream_upsert": f"""
WITH {ATTEMPTS}
SELECT rcept_no, seq, event_type FROM attempts
QUALIFY row_number() OVER (PARTITION BY rcept_no ORDER BY attempt_ts DESC, seq DESC) = 1""",
    "filing_ingest": f"""
WITH {PAGES}, {ARCHIVES},
todo AS (
  SELECT f.*, n.doc_id,
         CASE WHEN n_files > 200 THEN '.zip' ELSE n.ext END AS ext,
         CASE WHEN n_files > 200 THEN 'application/octet-stream' ELSE n.content_type END AS content_type,
         CASE WHEN n_files <= 200 THEN n.used_enc END AS used_enc,
         CASE WHEN n_files <= 200 THEN strlen(n.body) END AS size,
         CASE WHEN n_files <= 200 THEN md5(n.body) END AS digest,
         CASE WHEN f.rm = 'F' THEN 'exists' WHEN f.k % 16 = 0 AND n.doc_id IS NOT NULL THEN 'critical'
              WHEN f.k % 8 = 0 OR n.doc_id IS NULL THEN 'missing'
              WHEN strlen(n.body) < 200 THEN 'small' ELSE 'stored' END AS fate
  FROM filings f
  JOIN counted c ON c.date = f.rcept_dt AND c.page_no = f.k // 10000 + 1 AND c.n_items > 0
  LEFT JOIN normal n ON n.doc_id = f.k
  WHERE f.corp_cls <> 'Y' AND f.report_nm <> '1-URGENT')
SELECT rcept_no,
       CASE fate WHEN 'exists' THEN 'SKIPPED_EXISTS' WHEN 'small' THEN 'SKIPPED_TOO_SMALL' WHEN 'stored' THEN 'SUCCESS'
                 ELSE 'FAILED' END AS outcome,
       CASE fate WHEN 'critical' THEN 'DART API Error [010]: none' WHEN 'missing' THEN {NO_DOCUMENT}
                 WHEN 'small' THEN 'Processed file too small (' || size || ' bytes).' END AS reason,
       CASE WHEN fate = 'stored' THEN rcept_dt || '/' || rcept_no || ext END AS object_key,
       CASE WHEN fate = 'stored' THEN content_type END AS content_type,
       CASE WHEN fate IN ('small', 'stored') THEN size END AS file_size,
       CASE WHEN fate IN ('small', 'stored') THEN used_enc END AS used_enc,
       CASE WHEN fate = 'stored' THEN digest END AS body_md5
FROM todo""",
    "poll_twice": f"""
WITH {PAGES.replace("'%Y%m%d'", "'%Y%m01'")}, {ARCHIVES},
fates AS (
  SELECT f.rcept_no,
         CASE WHEN f.k % 16 = 0 AND n.doc_id IS NOT NULL THEN 'critical' WHEN f.k % 8 = 0 OR n.doc_id IS NULL THEN 'missing'
              WHEN n_files <= 200 AND strlen(n.body) < 200 THEN 'small' ELSE 'stored' END AS fate,
         strlen(n.body) AS size
  FROM filings f
  JOIN counted c ON c.date = f.rcept_dt AND c.page_no = f.k // 10000 + 1 AND c.n_items > 0
  LEFT JOIN normal n ON n.doc_id = f.k),
tries AS (SELECT * FROM fates, range(2) AS b(batch_id) WHERE b.batch_id = 0 OR fate IN ('critical', 'missing'))
SELECT rcept_no, batch_id::INT AS batch_id, 1::BIGINT AS seq,
       CASE fate WHEN 'small' THEN 'SKIPPED_TOO_SMALL' WHEN 'stored' THEN 'SUCCESS' ELSE 'FAILED' END AS outcome,
       CASE fate WHEN 'small' THEN 'size' WHEN 'stored' THEN 'store' ELSE 'download' END AS stage,
       CASE fate WHEN 'critical' THEN 'DART API Error [010]: none' WHEN 'missing' THEN {NO_DOCUMENT}
                 WHEN 'small' THEN 'Processed file too small (' || size || ' bytes).' END AS reason,
       CASE fate WHEN 'small' THEN 'SKIP' WHEN 'stored' THEN 'OK' END AS term,
       CASE WHEN fate IN ('small', 'stored') THEN 0 ELSE 2 END::BIGINT AS fails
FROM tries""",
    "poll_stream": f"""
WITH {PAGES.replace("'%Y%m%d'", "'%Y0101'")}, {ARCHIVES},
answers AS (
  SELECT f.rcept_no, f.rcept_dt, f.k, n.doc_id,
         CASE WHEN n.doc_id % 8 = 3 THEN 'PK' || chr(3) || chr(4) || d.text WHEN n_files <= 200 THEN n.body END AS body,
         CASE WHEN n.doc_id % 8 = 3 OR n_files > 200 THEN '.zip' ELSE n.ext END AS ext
  FROM filings f
  JOIN counted c ON c.date = f.rcept_dt AND c.page_no = f.k // 10000 + 1 AND c.n_items > 0
  LEFT JOIN normal n ON n.doc_id = f.k LEFT JOIN documents d ON d.doc_id = f.k
  WHERE f.report_nm <> '1-URGENT'),
fates AS (
  SELECT *, strlen(body) AS size,
         CASE WHEN doc_id % 16 = 0 THEN 'critical' WHEN doc_id % 8 = 0 OR doc_id IS NULL THEN 'missing'
              WHEN strlen(body) < 200 THEN 'small' ELSE 'stored' END AS fate
  FROM answers),
tries AS (
  SELECT *, CASE WHEN rcept_dt = '19990101' THEN 2 WHEN rcept_dt >= '19970101' THEN 1 ELSE 0 END AS batch_id,
         CASE WHEN rcept_dt < '19970101' AND doc_id % 2 = 1 THEN 'missing' ELSE fate END AS result
  FROM fates
  UNION ALL
  SELECT *, 1, fate FROM fates WHERE rcept_dt < '19970101' AND doc_id % 2 = 1),
counts AS (SELECT rcept_no, count_if(result IN ('critical', 'missing')) AS fails FROM tries GROUP BY rcept_no)
SELECT t.rcept_no, batch_id::INT AS batch_id, 1::BIGINT AS seq,
       CASE result WHEN 'small' THEN 'SKIPPED_TOO_SMALL' WHEN 'stored' THEN 'SUCCESS' ELSE 'FAILED' END AS outcome,
       CASE result WHEN 'small' THEN 'size' WHEN 'stored' THEN 'store' ELSE 'download' END AS stage,
       CASE result WHEN 'critical' THEN 'DART API Error [010]: none' WHEN 'missing' THEN {NO_DOCUMENT}
                   WHEN 'small' THEN 'Processed file too small (' || size || ' bytes).' END AS reason,
       CASE fate WHEN 'small' THEN 'SKIP' WHEN 'stored' THEN 'OK' END AS term,
       fails::BIGINT AS fails,
       CASE WHEN fate = 'stored' THEN rcept_dt || '/' || t.rcept_no || ext END AS object_key,
       CASE WHEN fate = 'stored' THEN md5(body) END AS body_md5
FROM tries t JOIN counts ON counts.rcept_no = t.rcept_no""",
    "object_files": f"""
WITH {WRAPPED}
SELECT '200201' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') || '/' || lpad(doc_id::VARCHAR, 10, '0') || '.txt' AS object_key,
       strlen(body) AS file_size, md5(body) AS body_md5
FROM wrapped""",
    "consume_messages": f"""
WITH {MESSAGES.replace("'%Y%m%d'", "'%Y%m01'")}
SELECT rcept_no, 'success' AS status, NULL::VARCHAR AS error_type, NULL::VARCHAR AS error_message, corp_code,
       '{{"reportName":"' || report_nm || '","corpCode":"' || corp_code || '","corpName":"' || corp_name
         || '","corpCls":"' || corp_cls || '","flrName":' || coalesce('"' || flr_nm || '"', 'null')
         || ',"receptionDate":"' || left(rcept_dt, 4) || '-' || substr(rcept_dt, 5, 2) || '-01T00:00:00Z"'
         || coalesce(',"stockCode":"' || stock_code || '"', '') || coalesce(',"remark":"' || rm || '"', '')
         || ',"minioObjectName":"' || object_key || '","contentType":"' || content_type || '","fileSize":' || file_size
         || '}}' AS body
FROM messages""",
}

ORACLE["filing_ingest_sliced"] = ORACLE["filing_ingest"]
ORACLE["poll_compacted"] = (
    ORACLE["poll_twice"].replace("range(2)", "range(3)").replace("'OK' END AS term", "'OK' ELSE 'PERM' END AS term").replace("ELSE 2 END", "ELSE 3 END")
)
ORACLE["upsert_compacted"] = ORACLE["stream_upsert"]
