"""Check SQL: for each registered query the same answer, written for DuckDB.

The statements are written from the rules and not from the Spark code: URLs are split
and judged row by row, chunks are unnested and grouped, verdicts are joined.
"""

from __future__ import annotations

from baitline import fixed_values as fv
from baitline.functions.strings import SPACE_CLASS, WEB_SPACE_CLASS
from baitline.operators.permutation import PRIME, Permutation
from baitline.workload import views as v


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(x) for x in values) + ")"


def _array(values) -> str:
    return "[" + ", ".join(_text(x) for x in values) + "]"


def _hits(column: str, words) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, {_text(w)}) AS INTEGER)" for w in words) + ")"


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"contains({column}, {_text(w)})" for w in words) + ")"


def _clean(column: str, n: int | None = None) -> str:
    done = f"trim(regexp_replace(coalesce({column}, ''), '{SPACE_CLASS}+', ' ', 'g'))"
    return done if n is None else f"left({done}, {n})"


def _round(value: str, digits: int = 2, scale: int = 6) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(18,{scale})), {digits}) AS DOUBLE)"


def _points(kind: str) -> str:
    return str(fv.URL_POINTS[kind])


MAIL = f"mail AS ({v.MAIL_SQL.replace('{documents}', 'documents')})"
RAW = "raw_json AS (" + v.RAW_SQL.replace("{quoted_sender}", "CAST(to_json(sender_email) AS VARCHAR)"
                                          ).replace("{quoted_body}", "CAST(to_json(body_text) AS VARCHAR)"
                                                    ).replace("{mail}", "mail").replace("{{", "{"
                                                                                        ).replace("}}", "}") + ")"
CLEAN = f"""clean AS (SELECT email_id, {_clean('subject', fv.SUBJECT_CHARS)} AS subject,
  {_clean('body_text', fv.BODY_CHARS)} AS body FROM mail)"""
CLEAN_WHOLE = f"""clean AS (SELECT email_id, {_clean('subject')} AS subject,
  {_clean('body_text')} AS body FROM mail)"""
CLEAN_NONE = "clean AS (SELECT email_id, subject, body_text AS body FROM mail)"
CHUNKS = f"""merged AS (SELECT email_id, regexp_replace(regexp_replace(
    subject || chr(10) || body, '^{SPACE_CLASS}+', ''), '{SPACE_CLASS}+$', '') AS t FROM clean),
chunks AS (SELECT email_id, CAST(s // {fv.CHUNK_STEP} AS INTEGER) AS pos,
    substring(t, s + 1, {fv.CHUNK_CHARS}) AS chunk
  FROM (SELECT email_id, t, unnest(range(0, length(t), {fv.CHUNK_STEP})) AS s FROM merged)),
chunk_values AS (SELECT email_id, pos, least(CAST(1 AS DOUBLE),
    {_hits('lower(chunk)', fv.TEXT_KEYWORDS)} * CAST(0.12 AS DOUBLE)
    + CAST(length(regexp_replace(chunk, '[^\\p{{Lu}}]+', '', 'g')) AS DOUBLE)
      / greatest(1, length(chunk)) * CAST(1.5 AS DOUBLE)
    + least(CAST(0.2 AS DOUBLE),
            length(regexp_replace(chunk, '[^!]+', '', 'g')) * CAST(0.01 AS DOUBLE))) AS value
  FROM chunks)"""


def _text_scores(aggregation: str) -> str:
    pick = {"mean": "avg", "max": "max"}[aggregation]
    return f"""text_scores AS (
  SELECT m.email_id, coalesce({_round('value * 100')}, 0) AS text_score,
    CASE WHEN n IS NULL THEN {_text(fv.TEXT_REASONS['empty'])}
      WHEN value >= 0.65 THEN {_text(fv.TEXT_REASONS['strong'])}
      WHEN value >= 0.35 THEN {_text(fv.TEXT_REASONS['some'])} ELSE '' END AS text_reasons,
    CAST(coalesce(n, 0) AS INTEGER) AS chunk_count,
    CASE WHEN n > 0 THEN '{aggregation}' END AS text_aggregation,
    CASE WHEN n > 0 THEN 'heuristic' END AS text_mode
  FROM merged m LEFT JOIN (SELECT email_id, {pick}(value) AS value, count(*) AS n
    FROM chunk_values GROUP BY email_id) USING (email_id))"""


MAIL_URLS = """mail_urls AS (
  SELECT email_id, url, CAST(row_number() OVER (PARTITION BY email_id ORDER BY p) - 1 AS INTEGER) AS pos
  FROM (SELECT email_id, url, min(p) AS p FROM (
    SELECT email_id, unnest(string_split(urls_joined, ' ')) AS url,
      generate_subscripts(string_split(urls_joined, ' '), 1) AS p FROM mail)
    WHERE url <> '' GROUP BY email_id, url))"""
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _parts(source: str) -> str:
    """URLs of a table split; none of the test URLs has brackets."""
    return f"""parts AS (
  SELECT url, host, path, query,
    regexp_full_match(host, '{_OCTET}(\\.{_OCTET}){{3}}') AS is_ip, string_split(host, '.') AS labels
  FROM (SELECT url, lower(split_part(regexp_extract(regexp_extract(url, '{_URI}', 2), '[^@]*$'), ':', 1)) AS host,
      regexp_replace(regexp_extract(url, '{_URI}', 3), ';[^/]*$', '') AS path,
      regexp_extract(url, '{_URI}', 4) AS query
    FROM (SELECT DISTINCT url FROM {source})))"""


def _judged(bad_domains: str, bad_ips: str) -> str:
    r, p = fv.URL_REASONS, _points
    long_test = f"length(url) > {fv.URL_LONG_OVER}"
    words = _any("lower(path || ' ' || query)", fv.URL_KEYWORDS) + " OR " + _any(
        "host", fv.URL_KEYWORDS)
    rules = [
        ("bad_ip", f"is_ip AND host IN ({bad_ips})", "host"),
        ("bad_domain", "bad IS NOT NULL", "bad"),
        ("ip_host", "is_ip", "host"),
        ("subdomains", "len(labels) - 2 >= 3", "host"),
        ("punycode", "contains(host, 'xn--')", "host"),
        ("shortener", f"host IN {_list(fv.SHORTENERS)}", "host"),
        ("keyword", words, "url"),
        ("tld", f"len(labels) > 1 AND labels[-1] IN {_list(fv.UNCOMMON_TLDS)}", "labels[-1]"),
        ("long", long_test, "''"),
    ]
    points = " + ".join(f"CASE WHEN {t} THEN {p(k)} ELSE 0 END" for k, t, _ in rules)
    reasons = "concat_ws(' ; ', " + ", ".join(
        f"CASE WHEN {t} THEN {_text(r[k])} || {d} END" for k, t, d in rules) + ")"
    return f"""feed_hits AS (
  SELECT host, min_by(domain, p) AS bad FROM (
    SELECT host, p, array_to_string(labels[p:], '.') AS domain FROM (
      SELECT host, labels, unnest(range(1, len(labels))) AS p FROM
        (SELECT DISTINCT host, labels FROM parts WHERE NOT is_ip)))
  WHERE domain IN ({bad_domains}) GROUP BY host),
judged AS (
  SELECT url, parts.host, CASE WHEN parts.host = '' THEN {p('malformed')} ELSE {points} END AS points,
    CASE WHEN parts.host = '' THEN {_text(r['malformed'])} || url ELSE {reasons} END AS reasons
  FROM parts LEFT JOIN feed_hits ON parts.host = feed_hits.host)""".replace(
        "contains(host", "contains(parts.host").replace("AND host IN", "AND parts.host IN").replace(
        "|| host", "|| parts.host").replace("WHEN host IN", "WHEN parts.host IN")


def _values(values) -> str:
    return ", ".join(_text(x) for x in values)


JUDGED = _judged(_values(fv.DEFAULT_BAD_DOMAINS), _values(fv.DEFAULT_BAD_IPS))
URL_SCORES = """url_scores AS (
  SELECT mail.email_id, CAST(least(100, coalesce(s, 0)) AS DOUBLE) AS url_score,
    coalesce(r, '') AS url_reasons, CAST(coalesce(n, 0) AS INTEGER) AS url_count
  FROM mail LEFT JOIN (SELECT email_id, sum(points) AS s, count(*) AS n,
    coalesce(string_agg(CASE WHEN reasons <> '' THEN reasons END, ' ; ' ORDER BY pos), '') AS r
    FROM mail_urls JOIN judged USING (url) GROUP BY email_id) USING (email_id))"""
DOMAINS = f"""senders AS (
  SELECT email_id, regexp_replace(sender_email, '^{SPACE_CLASS}+|{SPACE_CLASS}+$', '', 'g') AS address,
    trim(sender_name) AS name,
    CASE WHEN contains(sender_email, '@') THEN trim(lower(regexp_extract(sender_email, '[^@]*$'))) ELSE '' END AS domain
  FROM mail)"""
BRAND_HITS = "brand_hits AS (" + " UNION ALL ".join(
    f"SELECT email_id, domain, {i} AS ord, '{b.title()}' AS title FROM senders WHERE domain <> ''"
    f" AND contains(lower(name), '{b}') AND NOT contains(domain, '{d}')"
    for i, (b, d) in enumerate(fv.BRANDS) if d) + ")"
SENDER_SCORES = f"""sender_scores AS (
  SELECT email_id, domain AS sender_domain,
    CASE WHEN domain = '' THEN CAST(100 AS DOUBLE) ELSE CAST(least(100,
      CASE WHEN digits THEN 8 ELSE 0 END + CASE WHEN free THEN 6 ELSE 0 END + 25 * coalesce(n, 0)) AS DOUBLE)
      END AS sender_score,
    CASE WHEN domain = '' THEN {_text(fv.SENDER_REASONS['invalid'])} ELSE concat_ws(' ; ',
      CASE WHEN digits THEN {_text(fv.SENDER_REASONS['digits'])} END,
      CASE WHEN free THEN {_text(fv.SENDER_REASONS['free'])} END, claims) END AS sender_reasons
  FROM (SELECT *, regexp_matches(domain, '[0-9]{{3}}') AS digits,
      domain IN {_list(fv.FREE_PROVIDERS)} AS free FROM senders)
  LEFT JOIN (SELECT email_id, count(*) AS n, string_agg({_text(fv.SENDER_REASONS['brand'][0])} || title
      || {_text(fv.SENDER_REASONS['brand'][1])} || domain, ' ; ' ORDER BY ord) AS claims
    FROM brand_hits GROUP BY email_id) USING (email_id))"""
FILES = """files AS (
  SELECT email_id, p, name, CASE WHEN contains(name, '.') THEN lower(regexp_extract(name, '[^.]*$')) ELSE '' END AS ext
  FROM (SELECT email_id, unnest(string_split(files_joined, ' ')) AS name,
    generate_subscripts(string_split(files_joined, ' '), 1) AS p FROM mail) WHERE name <> '')"""


def _file_rules() -> str:
    tests = {
        "executable": f"ext IN {_list(fv.EXECUTABLE_EXTENSIONS)}",
        "macro": f"ext IN {_list(fv.MACRO_EXTENSIONS)}",
        "archive": f"ext IN {_list(fv.ARCHIVE_EXTENSIONS)}",
        "double": "len(string_split(name, '.')) >= 3 AND string_split(lower(name), '.')[-1] IN "
                  + _list(fv.EXECUTABLE_EXTENSIONS),
    }
    return " UNION ALL ".join(
        f"SELECT email_id, p, {i} AS k, {fv.ATTACHMENT_POINTS[kind]} AS points,"
        f" {_text(fv.ATTACHMENT_REASONS[kind])} || name AS reason FROM files WHERE {test}"
        for i, (kind, test) in enumerate(tests.items()))


ATTACHMENT_SCORES = f"""file_hits AS ({_file_rules()}),
attachment_scores AS (
  SELECT email_id, CAST(least(100, coalesce(s, 0)) AS DOUBLE) AS attachment_score,
    coalesce(r, '') AS attachment_reasons, CAST(coalesce(n, 0) AS INTEGER) AS attachment_count
  FROM mail LEFT JOIN (SELECT email_id, sum(points) AS s, string_agg(reason, ' ; ' ORDER BY p, k) AS r
    FROM file_hits GROUP BY email_id) USING (email_id)
  LEFT JOIN (SELECT email_id, count(*) AS n FROM files GROUP BY email_id) USING (email_id))"""


def _level(score: str) -> str:
    return f"CASE WHEN {score} >= 70 THEN 'high' WHEN {score} >= 40 THEN 'medium' ELSE 'low' END"


def _action(level: str) -> str:
    return (f"CASE {level} WHEN 'high' THEN {_text(fv.ACTIONS['high'])} WHEN 'medium' THEN"
            f" {_text(fv.ACTIONS['medium'])} ELSE {_text(fv.ACTIONS['low'])} END")


VERDICTS = f"""weighted AS (
  SELECT email_id, text_score, url_score, sender_score, attachment_score,
    {_round('''least(CAST(100 AS DOUBLE), text_score * CAST(0.4 AS DOUBLE) + url_score * CAST(0.25 AS DOUBLE)
      + sender_score * CAST(0.2 AS DOUBLE) + attachment_score * CAST(0.15 AS DOUBLE))''')} AS risk_score,
    concat_ws(' ; ', nullif(text_reasons, ''), nullif(url_reasons, ''), nullif(sender_reasons, ''),
      nullif(attachment_reasons, '')) AS said
  FROM text_scores JOIN url_scores USING (email_id) JOIN sender_scores USING (email_id)
    JOIN attachment_scores USING (email_id)),
verdicts AS (
  SELECT email_id, risk_score, {_level('risk_score')} AS risk_level,
    CASE WHEN said = '' THEN {_text(fv.NO_REASON)}
      ELSE array_to_string(string_split(said, ' ; '), ' ; ') END AS reasons,
    text_score, url_score, sender_score, attachment_score,
    {_action(_level('risk_score'))} AS recommended_action
  FROM weighted)"""
INDICATOR_CHAIN = [CLEAN_WHOLE, CHUNKS, _text_scores("mean"), MAIL_URLS, _parts("mail_urls"), JUDGED,
                   URL_SCORES, DOMAINS, BRAND_HITS, SENDER_SCORES, FILES, ATTACHMENT_SCORES, VERDICTS]
SCORED = [MAIL, *INDICATOR_CHAIN]
_POLICY_ROWS = ", ".join(f"({_text(d)}, {_text(a)})" for d, a in v.POLICY)
LISTED = f"""policy AS (SELECT domain, max(action) AS action
    FROM (VALUES {_POLICY_ROWS}) AS t(domain, action) GROUP BY domain),
listed AS (SELECT email_id, domain, action FROM (SELECT email_id,
    CASE WHEN contains(sender_email, '@') THEN lower(regexp_extract(sender_email, '[^@]*$')) END AS domain
    FROM mail) JOIN policy USING (domain))"""

HIDDEN = (r"(?is)<!--.*?-->|<head\b.*?</head\s*>|<script\b.*?</script\s*>|<style\b.*?</style\s*>")


def _unescape(x: str) -> str:
    for entity, sign in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        x = f"replace({x}, '{entity}', '{sign}')"
    return x


def _web_clean(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WEB_SPACE_CLASS}+', ' ', 'g'))"


def _visible(x: str) -> str:
    # The pages use two kinds of inline tags, <a> and <b>; all other tags break the text.
    shown = f"regexp_replace({x}, '{HIDDEN}', ' ', 'g')"
    return _web_clean(_unescape(
        f"regexp_replace(regexp_replace({shown}, '</?[ab]( [^>]*)?>', '', 'g'), '<[^<>]+>', ' ', 'g')"))


_ADDRESS = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PAGE_EMAILS = f"""page_text AS (
  SELECT page_id AS email_id, url, split_part(url, '/', 3) AS host,
    regexp_extract(url, '^[a-z]+://[^/]*') AS origin, {_visible('html')} AS body_text,
    {_web_clean(_unescape("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} AS title,
    regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages),
page_links AS (
  SELECT email_id, u, min(p) AS p FROM (
    SELECT email_id, url AS u, 0 AS p FROM page_text UNION ALL
    SELECT email_id, origin || unnest(hrefs) AS u, generate_subscripts(hrefs, 1) AS p FROM page_text)
  GROUP BY email_id, u),
page_emails AS (
  SELECT email_id,
    CASE WHEN regexp_matches(body_text, '{_ADDRESS}') THEN regexp_extract(body_text, '{_ADDRESS}')
      ELSE 'no-reply@' || host END AS sender_email, host AS sender_name,
    CASE WHEN title = '' THEN host ELSE title END AS subject, body_text, urls, 'webpage' AS page_source
  FROM page_text JOIN (SELECT email_id, list(u ORDER BY p) AS urls FROM page_links
    GROUP BY email_id) USING (email_id))"""


def _fingerprint(urls: str) -> str:
    whole = f"sender_email || '||' || subject || '||' || left(body_text, 400) || '||' || {urls}"
    return f"left(base64(encode({whole})), 120)"


FINGERPRINTS = [MAIL, MAIL_URLS, PAGE_EMAILS, f"""fingerprints AS (
  SELECT 'page' AS kind, email_id, {_fingerprint("array_to_string(urls, '|')")} AS fingerprint FROM page_emails
  UNION ALL SELECT 'mail', email_id, {_fingerprint("replace(urls_joined, ' ', '|')")} FROM mail)"""]
_DAYS = 3 * 86400 * 1000000
PAGE_VISITS = f"""page_visits AS (
  SELECT user_id AS tab, event_id AS seq, epoch_us(ts) AS ts_us, page_id, fingerprint
  FROM (SELECT *, (user_id * 7 + epoch_us(ts) // {_DAYS}) % (SELECT count(*) FROM pages) AS page_id FROM events)
  JOIN (SELECT email_id AS page_id, fingerprint FROM fingerprints WHERE kind = 'page') USING (page_id))"""
MAIL_VISITS = f"""mail_visits AS (
  SELECT CASE WHEN event_id % 17 <> 0 THEN user_id END AS tab, event_id AS seq, epoch_us(ts) AS ts_us,
    (user_id * 7 + epoch_us(ts) // {_DAYS}) % (SELECT count(*) FROM documents) AS email_id FROM events)"""
ALERTS = f"""alerts AS (
  SELECT email_id, upper(risk_level) || {_text(fv.ALERT_TITLE)} AS title,
    left(coalesce(nullif(subject, ''), nullif(sender_name, ''), nullif(sender_email, ''), 'Current page')
      || chr(10) || 'Score: ' || regexp_replace(CAST(risk_score AS VARCHAR), '\\.0$', '') || chr(10)
      || string_split(reasons, ' ; ')[1], 500) AS message,
    CASE risk_level WHEN 'high' THEN 2 ELSE 1 END AS priority,
    CASE risk_level WHEN 'high' THEN 1 ELSE 0 END AS sticky, risk_level
  FROM verdicts JOIN mail USING (email_id)
  WHERE page_source = 'webpage' AND risk_level IN ('medium', 'high'))"""

RAW_LINES = """lines AS (
  SELECT DISTINCT trim(value, ' ' || chr(9)) AS url FROM (
    SELECT unnest(string_split(urls_joined, ' ')) AS value FROM mail
    UNION ALL SELECT '  ' || url || ' ' || chr(9) FROM pages)
  WHERE trim(value, ' ' || chr(9)) <> '')"""
_URL_FEED = "SELECT host FROM parts WHERE {} AND host <> ''"
GOOD = f"""good AS (SELECT doc_id AS id, CASE WHEN doc_id % 5 = 0 THEN 'http' ELSE 'https' END || '://www.'
    || ({_array(fv.SAFE_DOMAINS)})[doc_id % 20 + 1]
    || ({_array(fv.SAFE_PATHS)})[doc_id // 20 % 10 + 1] AS url FROM documents)"""


def _draw(name: str, column: str, n: int = 5) -> str:
    return (f"(CAST(('0x' || left(md5('{fv.SEED}:{name}:' || CAST({column} AS VARCHAR)), 8)) AS BIGINT)"
            f" % {n} + 1)")


def _benign(source: str, column: str) -> str:
    return f"""SELECT {column} AS id,
    ({_array(a for a, _ in fv.BENIGN_SENDERS)})[{_draw('sender', column)}] AS sender_email,
    ({_array(n for _, n in fv.BENIGN_SENDERS)})[{_draw('sender', column)}] AS sender_name,
    ({_array(fv.BENIGN_SUBJECTS)})[{_draw('subject', column)}] AS subject,
    ({_array(fv.BENIGN_BODIES)})[{_draw('body', column)}] AS body_text,
    ({_array(fv.BENIGN_URLS)})[{_draw('url', column)}] AS urls,
    '' AS attachments, 0 AS label FROM {source}"""


TRAINING = f"""training AS (SELECT email_id AS id, sender_email, coalesce(sender_name, '') AS sender_name,
    subject, body_text, replace(urls_joined, ' ', ';') AS urls,
    replace(files_joined, ' ', ';') AS attachments, {v.LABEL_SQL} AS label FROM mail)"""
_T = {c: f"regexp_replace({c}, '^{SPACE_CLASS}+|{SPACE_CLASS}+$', '', 'g')" for c in
      ("sender_email", "subject", "body_text", "urls", "attachments")}
TEXTS = f"""texts AS (SELECT id, label, trim({_T['subject']} || ' ' || {_T['body_text']}) AS classic,
    '[SENDER] ' || {_T['sender_email']} || ' [SUBJECT] ' || {_T['subject']} || ' [BODY] ' || {_T['body_text']}
    || ' [URLS] ' || {_T['urls']} || ' [ATTACHMENTS] ' || {_T['attachments']} AS tagged FROM training)"""


def _metrics(source: str) -> str:
    def ratio(top: str, bottom: str) -> str:
        return f"CASE WHEN {bottom} > 0 THEN {_round(f'CAST({top} AS DOUBLE) / ({bottom})', 4, 9)} ELSE 0 END"

    return f"""SELECT {ratio('ok', 'n')} AS accuracy, {ratio('tp', '(tp + fp)')} AS "precision",
    {ratio('tp', '(tp + fn)')} AS recall, {ratio('2 * tp', '(2 * tp + fp + fn)')} AS f1
  FROM (SELECT count(*) AS n, count(*) FILTER (y_true = y_pred) AS ok,
      count(*) FILTER (y_true = 1 AND y_pred = 1) AS tp, count(*) FILTER (y_true <> 1 AND y_pred = 1) AS fp,
      count(*) FILTER (y_true = 1 AND y_pred <> 1) AS fn FROM {source})"""


MAIL_LINKS = r"(?i)https?://[^\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}""" + "\"''<>]+"


def _sql(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _verdict_columns(alias: str = "verdicts") -> str:
    return (f"SELECT email_id, risk_score, risk_level, reasons, text_score, url_score, sender_score,"
            f" attachment_score, recommended_action FROM {alias}")


def _intake_errors() -> str:
    """Errors from JSON types. Integers carry several type names, so they are tested by list."""
    def kind(path: str) -> str:
        return f"json_type(raw, '$.{path}')"

    missing = "concat_ws(' ; ', " + ", ".join(
        f"CASE WHEN {kind(f)} IS NULL THEN 'Missing required field: {f}' END"
        for f in fv.REQUIRED_FIELDS) + ")"
    number = "('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')"

    def item(field: str, test: str, text: str) -> str:
        return (f"CASE WHEN {test} THEN 'attachments[' || i || '].{field} must be {text}' END")

    def not_text(f: str) -> str:
        return f"coalesce(json_type(item, '$.{f}'), 'NONE') <> 'VARCHAR'"

    return f"""items AS (SELECT email_id, json_extract(raw, '$.attachments[' || i || ']') AS item, i FROM (
    SELECT email_id, raw, unnest(range(0, CAST(json_array_length(raw, '$.attachments') AS BIGINT))) AS i
    FROM objects WHERE json_type(raw, '$.attachments') = 'ARRAY')),
item_errors AS (SELECT email_id, string_agg(nullif(e, ''), ' ; ' ORDER BY i) AS e FROM (
    SELECT email_id, i, CASE WHEN json_type(item) <> 'OBJECT' THEN 'attachments[' || i || '] must be an object'
      ELSE concat_ws(' ; ', {item('filename', not_text('filename'), 'a string')},
        {item('extension', not_text('extension'), 'a string')},
        {item('size_kb', f"coalesce(json_type(item, '$.size_kb'), 'NONE') NOT IN {number}", 'numeric')},
        {item('mime_type', not_text('mime_type'), 'a string')}) END AS e FROM items) GROUP BY email_id),
other AS (SELECT email_id, count(*) AS n FROM (SELECT email_id, unnest(json_extract(raw, '$.urls[*]')) AS u
    FROM objects) WHERE json_type(u) <> 'VARCHAR' GROUP BY email_id),
complaints AS (SELECT email_id, CASE WHEN {missing} <> '' THEN {missing} ELSE concat_ws(' ; ',
      CASE WHEN {kind('sender_email')} <> 'VARCHAR' OR trim(raw->>'$.sender_email') = ''
        THEN 'sender_email must be a non-empty string' END,
      CASE WHEN coalesce({kind('sender_name')}, 'NULL') NOT IN ('NULL', 'VARCHAR')
        THEN 'sender_name must be a string when provided' END,
      CASE WHEN {kind('subject')} <> 'VARCHAR' THEN 'subject must be a string' END,
      CASE WHEN {kind('body_text')} <> 'VARCHAR' THEN 'body_text must be a string' END,
      CASE WHEN {kind('urls')} <> 'ARRAY' OR n > 0 THEN 'urls must be a list of strings' END,
      CASE WHEN {kind('attachments')} <> 'ARRAY' THEN 'attachments must be a list' END, e) END AS errors
  FROM objects LEFT JOIN other USING (email_id) LEFT JOIN item_errors USING (email_id)
  UNION ALL SELECT email_id, {_text(fv.NOT_AN_OBJECT)} FROM raw_json
  WHERE email_id NOT IN (SELECT email_id FROM objects))"""


OBJECTS = """objects AS (SELECT email_id, raw FROM (
    SELECT email_id, CASE WHEN json_valid(raw) THEN raw END AS raw FROM raw_json)
    WHERE json_type(raw) = 'OBJECT')"""
INTAKE = [MAIL, RAW, OBJECTS, _intake_errors()]


def _permuted(table: str, key: str) -> str:
    """Place of every row, numbered by ``key``: digits mixed round by round, again for places beyond the rows."""
    mixed = (f"SELECT {key}, step + 1 AS step, n, hi, lo, x // lo AS d0, x % lo AS d1 "
             "FROM walk, sizes WHERE step = 0 OR x >= n")
    for k, (times, plus) in enumerate(Permutation(1).keys):
        to, by, size, rest = ("d0", "d1", "hi", "d1") if k % 2 == 0 else ("d1", "d0", "lo", "d0")
        power = f"(y * y % {PRIME} * (y * y % {PRIME}) % {PRIME} * y % {PRIME})"
        mixed = (f"SELECT {key}, step, n, hi, lo, ({to} + {power}) % {size} AS {to}, {rest} FROM "
                 f"(SELECT *, ({by} * {times} + {plus}) % {PRIME} AS y FROM ({mixed}))")
    return f"""WITH RECURSIVE sizes AS (SELECT n, hi, CAST(ceil(n / hi) AS BIGINT) AS lo FROM (
      SELECT n, CAST(ceil(sqrt(n)) AS BIGINT) AS hi FROM (SELECT count(*) AS n FROM {table}))),
    walk AS (SELECT {key}, 0 AS step, row_number() OVER (ORDER BY {key}) - 1 AS x FROM {table}
      UNION ALL SELECT {key}, step, d0 * lo + d1 FROM ({mixed}))
    SELECT {key}, arg_max(x, step) AS place FROM walk GROUP BY {key}"""


def statements() -> dict[str, str]:
    s: dict[str, str] = {}
    s["intake_errors"] = _sql(INTAKE, "SELECT email_id, errors FROM complaints WHERE errors <> ''")
    s["intake_valid"] = _sql(INTAKE, """SELECT email_id, trim(raw->>'$.sender_email') AS sender_email,
      trim(raw->>'$.sender_name') AS sender_name, raw->>'$.subject' AS subject,
      raw->>'$.body_text' AS body_text, array_to_string(raw->>'$.urls[*]', ' ') AS urls,
      CAST(json_array_length(raw, '$.attachments') AS INTEGER) AS n_files,
      trim(lower(raw->>'$.attachments[0].extension'), '.') AS extension,
      CAST(CASE raw->>'$.attachments[0].size_kb' WHEN 'true' THEN '1'
        ELSE raw->>'$.attachments[0].size_kb' END AS DOUBLE) AS size_kb
      FROM objects JOIN complaints USING (email_id) WHERE errors = ''""")
    s["emails_normalized"] = _sql([MAIL, DOMAINS, FILES], """SELECT s.email_id, address AS sender_email,
      name AS sender_name, coalesce(e, '') AS extensions FROM senders s LEFT JOIN
      (SELECT email_id, string_agg(ext, ' ' ORDER BY p) AS e FROM files GROUP BY email_id) USING (email_id)""")
    s["clean_text"] = _sql([MAIL, CLEAN], """SELECT email_id, subject,
      CAST(length(body) AS INTEGER) AS n_chars, md5(body) AS body_md5 FROM clean""")
    s["clean_whole_text"] = f"SELECT doc_id, md5({_clean('text')}) AS text_md5 FROM documents"
    s["urls_deduped"] = _sql([MAIL, MAIL_URLS], """SELECT mail.email_id, coalesce(u, '') AS urls,
      CAST(coalesce(n, 0) AS INTEGER) AS n_urls FROM mail LEFT JOIN (SELECT email_id,
      string_agg(url, ' ' ORDER BY pos) AS u, count(*) AS n FROM mail_urls GROUP BY email_id)
      USING (email_id)""")
    s["url_lines"] = _sql([MAIL, RAW_LINES], "SELECT url FROM lines")
    s["url_parts"] = _sql([MAIL, RAW_LINES, _parts("lines")],
                          "SELECT url, host, path, query, CAST(is_ip AS INTEGER) AS is_ip FROM parts")
    s["sender_domains"] = _sql([MAIL, DOMAINS], """SELECT email_id, domain AS sender_domain,
      CASE WHEN contains(sender_email, '@') THEN lower(split_part(sender_email, '@', 2)) ELSE '' END
      AS policy_domain FROM senders JOIN mail USING (email_id)""")
    s["extract_sender"] = _sql([MAIL], f"""SELECT email_id, a AS sender_email,
      trim(replace(CASE WHEN a = '' THEN h ELSE replace(h, a, '') END, '<>', ''), '" <>') AS sender_name
      FROM (SELECT email_id, h, lower(regexp_extract(h, '{_ADDRESS}')) AS a FROM (SELECT email_id,
      '"' || coalesce(sender_name, '') || '" <' || sender_email || '>' AS h FROM mail))""")
    s["feed_parse"] = _sql([MAIL], """SELECT DISTINCT lower(t) AS domain FROM (
      SELECT unnest(regexp_split_to_array(upper(sender_email) || ', ' || urls_joined || ', '
        || 'c.org,,a.com', '[,\\s]+')) AS t FROM mail) WHERE t <> ''""")
    s["policy_parse"] = _sql([MAIL], """SELECT DISTINCT lower(trim(t)) AS domain, 'block' AS action FROM (
      SELECT unnest(string_split(concat_ws(',', upper(sender_email), sender_name), ',')) AS t FROM mail)
      WHERE trim(t) <> ''""")
    s["text_chunks"] = _sql([MAIL, CLEAN_WHOLE, CHUNKS], """SELECT email_id, pos,
      CAST(length(chunk) AS INTEGER) AS n_chars, md5(chunk) AS chunk_md5 FROM chunks""")
    s["keyword_scores"] = _sql([MAIL, CLEAN_NONE, CHUNKS], f"""SELECT email_id, pos,
      {_round('value', 6, 9)} AS chunk_score FROM chunk_values""")
    s["text_scores"] = _sql([MAIL, CLEAN_WHOLE, CHUNKS, _text_scores("mean")], "SELECT * FROM text_scores")
    s["text_scores_max"] = _sql([MAIL, CLEAN_WHOLE, CHUNKS, _text_scores("max")],
                                "SELECT * FROM text_scores")
    s["text_scores_whole"] = _sql([MAIL, CLEAN_WHOLE, CHUNKS, _text_scores("mean")],
                                  "SELECT * FROM text_scores")
    links = [MAIL, MAIL_URLS, _parts("mail_urls"), JUDGED]
    s["url_findings"] = _sql(links, """SELECT email_id, pos, url, host, CAST(points AS INTEGER) AS points,
      reasons FROM mail_urls JOIN judged USING (url)""")
    s["url_scores"] = _sql([*links, URL_SCORES], "SELECT * FROM url_scores")
    own = _judged(_URL_FEED.format("NOT is_ip AND host LIKE '%secure-%'"), _URL_FEED.format("is_ip"))
    s["url_scores_table_feed"] = _sql([*links[:-1], own, URL_SCORES],
                                      "SELECT email_id, url_score, url_count FROM url_scores")
    s["url_scores_long_feed"] = s["url_scores_table_feed"]
    s["url_reputation"] = _sql(links, f"""SELECT DISTINCT host, host AS matched, 'ip' AS feed FROM parts
      WHERE host IN ({_values(fv.DEFAULT_BAD_IPS)})
      UNION ALL SELECT host, bad, 'domain' FROM feed_hits""")
    s["brand_mismatch"] = _sql([MAIL, DOMAINS, BRAND_HITS], """SELECT email_id, domain AS sender_domain,
      CAST(row_number() OVER (PARTITION BY email_id ORDER BY ord) - 1 AS INTEGER) AS pos, title
      FROM brand_hits""")
    s["keyword_table_hits"] = """SELECT doc_id, count(*) AS n_patterns FROM documents JOIN (
      SELECT DISTINCT string_split(lower(text), ' ')[1] AS word FROM documents) ON contains(lower(text), word)
      WHERE word <> '' GROUP BY doc_id"""
    s["brand_table_mismatch"] = _sql([MAIL, DOMAINS], """SELECT email_id, upper(b[1]) || b[2:] AS title
      FROM senders JOIN (SELECT DISTINCT lower(split_part(sender_name, ' ', 1)) AS b FROM mail
        WHERE sender_name IS NOT NULL) ON contains(lower(name), b)
      WHERE domain <> '' AND NOT contains(domain, b || '.com')""")
    s["sender_scores"] = _sql([MAIL, DOMAINS, BRAND_HITS, SENDER_SCORES], "SELECT * FROM sender_scores")
    s["attachment_scores"] = _sql([MAIL, FILES, ATTACHMENT_SCORES], "SELECT * FROM attachment_scores")
    s["risk_verdicts"] = s["score_emails"] = _sql(SCORED, _verdict_columns())
    s["policy_verdicts"] = _sql([*SCORED, LISTED], f"""SELECT email_id,
      CASE action WHEN 'block' THEN 100 WHEN 'allow' THEN 0 ELSE risk_score END AS risk_score,
      CASE action WHEN 'block' THEN 'high' WHEN 'allow' THEN 'low' ELSE risk_level END AS risk_level,
      CASE action WHEN 'block' THEN domain || {_text(fv.POLICY_REASONS['block'])}
        WHEN 'allow' THEN domain || {_text(fv.POLICY_REASONS['allow'])} ELSE reasons END AS reasons,
      CASE WHEN action IS NULL THEN text_score ELSE 0 END AS text_score,
      CASE WHEN action IS NULL THEN url_score ELSE 0 END AS url_score,
      CASE action WHEN 'block' THEN 100 WHEN 'allow' THEN 0 ELSE sender_score END AS sender_score,
      CASE WHEN action IS NULL THEN attachment_score ELSE 0 END AS attachment_score,
      CASE action WHEN 'block' THEN {_text(fv.POLICY_ACTIONS['block'])}
        WHEN 'allow' THEN {_text(fv.POLICY_ACTIONS['allow'])} ELSE recommended_action END AS recommended_action
      FROM verdicts LEFT JOIN listed USING (email_id)""")
    s["manual_verdicts"] = _sql([*SCORED, LISTED], f"""SELECT email_id,
      CASE action WHEN 'block' THEN 100 WHEN 'allow' THEN 0 ELSE risk_score END AS risk_score,
      CASE action WHEN 'block' THEN 'high' WHEN 'allow' THEN 'low' ELSE risk_level END AS risk_level,
      CASE action WHEN 'block' THEN domain || {_text(fv.POLICY_REASONS['block'])}
        WHEN 'allow' THEN domain || {_text(fv.POLICY_REASONS['allow'])} ELSE reasons END AS reasons,
      CASE WHEN action IS NULL THEN recommended_action END AS recommended_action
      FROM verdicts LEFT JOIN listed USING (email_id)""")
    s["badges"] = _sql(SCORED, """SELECT email_id, risk_level,
      CASE risk_level WHEN 'high' THEN 'HIGH' WHEN 'medium' THEN 'MED' ELSE 'LOW' END AS badge_text,
      CASE risk_level WHEN 'high' THEN '#b83232' WHEN 'medium' THEN '#b7791f' ELSE '#2d7d46' END
      AS badge_color FROM verdicts""")
    s["alerts"] = _sql([*SCORED, ALERTS],
                           "SELECT email_id, title, message, priority, sticky FROM alerts")
    prints = [*SCORED, ALERTS, FINGERPRINTS[2], FINGERPRINTS[3], MAIL_VISITS]
    s["alerts_deduped"] = _sql(prints, """SELECT tab, seq, ts_us, email_id, title, alert_key FROM (
      SELECT *, lag(alert_key) OVER (PARTITION BY tab ORDER BY ts_us, seq) AS shown FROM (
        SELECT tab, seq, ts_us, email_id, title, fingerprint || ':' || risk_level AS alert_key
        FROM mail_visits JOIN alerts USING (email_id)
        JOIN (SELECT email_id, fingerprint FROM fingerprints WHERE kind = 'mail') USING (email_id)))
      WHERE tab IS NULL OR shown IS DISTINCT FROM alert_key""")
    s["latest_verdict"] = _sql([*SCORED, MAIL_VISITS], """SELECT tab, seq, ts_us, email_id, risk_score,
      risk_level FROM (SELECT *, row_number() OVER (PARTITION BY tab ORDER BY ts_us DESC, seq DESC) AS r
      FROM mail_visits WHERE tab IS NOT NULL) JOIN verdicts USING (email_id) WHERE r = 1""")
    s["pages_to_emails"] = _sql([PAGE_EMAILS], """SELECT email_id, sender_email, sender_name, subject,
      CAST(length(body_text) AS INTEGER) AS n_chars, md5(body_text) AS body_md5,
      array_to_string(urls, ' ') AS urls, page_source FROM page_emails""")
    s["mail_view_to_emails"] = _sql([PAGE_EMAILS], f"""SELECT page_id AS email_id,
      CASE WHEN page_id % 3 > 0 THEN 'Box@' || host ELSE 'Team ' || page_id END AS sender_email,
      'Team ' || page_id AS sender_name, title AS subject,
      md5({_visible("html || '<a>more</a>'")}) AS body_md5, pages.url AS urls,
      CASE WHEN page_id % 2 = 0 THEN 'zip|' ELSE '' END AS extensions,
      CASE WHEN page_id % 2 = 0 THEN 2 ELSE 0 END AS n_files
      FROM pages JOIN page_text ON page_id = email_id""")
    s["page_verdicts"] = _sql(
        [PAGE_EMAILS, """mail AS (SELECT email_id, sender_email, sender_name, subject, body_text,
          array_to_string(urls, ' ') AS urls_joined, '' AS files_joined FROM page_emails)""",
         *INDICATOR_CHAIN], _verdict_columns())
    s["capture_filter"] = _sql([MAIL], """SELECT email_id, page_source FROM mail WHERE sender_email <> ''
      AND subject <> '' AND body_text <> '' AND NOT (page_source = 'webpage' AND length(body_text) < 80)""")
    s["fingerprint"] = _sql(FINGERPRINTS, "SELECT * FROM fingerprints")
    s["capture_changes"] = _sql([*FINGERPRINTS, PAGE_VISITS], """SELECT tab, seq, ts_us, page_id, fingerprint
      FROM (SELECT *, lag(fingerprint) OVER (PARTITION BY tab ORDER BY ts_us, seq) AS f FROM page_visits)
      WHERE f IS DISTINCT FROM fingerprint""")
    s["debounced_captures"] = """SELECT user_id AS tab, event_id AS seq, epoch_us(ts) AS ts_us, event_type
      FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
      WHERE n IS NULL OR n - ts >= INTERVAL 30 MINUTE"""
    s["text_urls"] = _sql([MAIL], f"""SELECT email_id, array_to_string(u, ' ') AS urls,
      array_to_string(list_sort(list_distinct(u)), ';') AS url_set
      FROM (SELECT email_id, regexp_extract_all(body_text || ' ' || urls_joined, '{MAIL_LINKS}') AS u
      FROM mail)""")
    s["mail_archive"] = _sql([MAIL], f"""SELECT 'mail/' || email_id || '.eml' AS path,
      'box' || email_id || '@mail.example.com' AS sender_email,
      trim(coalesce(sender_name, '') || ' <Box' || email_id || '@Mail.Example.COM', '" <>') AS sender_name,
      {_clean('subject')} AS subject,
      md5(CASE email_id % 5 WHEN 1 THEN '(empty body)' WHEN 0 THEN
        {_clean("regexp_replace('<html><p>' || body_text || '</p><b> See ' || urls_joined || ' now</b>', '<[^>]+>', ' ', 'g')")}
        ELSE {_clean("body_text || ' See ' || urls_joined || ' now'")} END) AS body_md5,
      CASE WHEN email_id % 5 = 1 THEN '' ELSE array_to_string(list_sort(list_distinct(regexp_extract_all(
        body_text || ' ' || urls_joined, '{MAIL_LINKS}'))), ';') END AS urls,
      CASE WHEN email_id % 5 > 1 THEN files_joined ELSE '' END AS attachments, 1 AS label FROM mail""")
    boxed = "(CAST(regexp_extract(path, '(\\d+)', 1) AS BIGINT) % 11 <> 0)"
    s["mail_boxes"] = s["stream_mail"] = f"SELECT * EXCLUDE (path) FROM ({s['mail_archive']}) WHERE {boxed}"
    s["mail_rejected"] = """SELECT 'IndexError: list index out of range' AS error, count(*) AS n FROM documents
      WHERE doc_id % 11 = 0 HAVING count(*) > 0"""
    s["benign_urls"] = _sql([GOOD], "SELECT id, url FROM good")
    s["benign_emails"] = _benign("documents", "doc_id")
    sample = """SELECT url FROM (SELECT url, row_number() OVER (ORDER BY md5('42' || url), url) AS r
      FROM lines) WHERE r <= """
    s["url_sample"] = _sql([MAIL, RAW_LINES], sample + "(SELECT count(*) // 2 FROM lines)")
    testset = f"""testset AS (SELECT url, 1 AS y_true FROM ({sample}(SELECT count(*) FROM documents))
      UNION ALL SELECT url, 0 FROM good)"""
    s["url_testset"] = _sql([MAIL, RAW_LINES, GOOD, testset], "SELECT url, y_true FROM testset")
    s["training_set"] = _sql([MAIL, TRAINING, """picked AS (SELECT * FROM training WHERE label = 1)""",
                              """ids AS (SELECT unnest(range(0, (SELECT count(*) // 2 FROM picked))) AS i)""",
                              f"benign AS ({_benign('ids', 'i')})"],
                             """SELECT sender_email, sender_name, subject, md5(body_text) AS body_md5, urls,
      attachments, label FROM (SELECT * FROM picked UNION ALL BY NAME SELECT * FROM benign)""")
    s["stratified_split"] = _sql([MAIL, TRAINING], """SELECT id, label, CASE WHEN row_number() OVER
      (PARTITION BY label ORDER BY md5('42' || id), id) <= ceil(count(*) OVER (PARTITION BY label) * 0.2)
      THEN 'validation' ELSE 'train' END AS part FROM training""")
    s["balanced_head"] = _sql([MAIL, TRAINING], """SELECT id, label FROM (SELECT id, label, row_number()
      OVER (PARTITION BY label ORDER BY id) AS r FROM training) WHERE r <= 300""")
    s["training_text"] = _sql([MAIL, TRAINING, TEXTS], """SELECT id, 'tagged' AS layout, md5(tagged) AS text_md5
      FROM texts UNION ALL SELECT id, 'classic', md5(classic) FROM texts""")
    s["training_csv"] = _sql([MAIL, TRAINING, TEXTS], """SELECT sender_email, sender_name, subject,
      md5(body_text) AS body_md5, urls, attachments, label, md5(tagged) AS text_md5
      FROM training JOIN (SELECT id, tagged FROM texts) USING (id)""")
    s["hand_features"] = _sql([MAIL, TRAINING], f"""SELECT id,
      {_hits("lower(subject || ' ' || body_text)", fv.TRAINING_KEYWORDS)} AS keyword_hits,
      CAST(regexp_matches(lower(urls), 'https?://\\d+\\.\\d+\\.\\d+\\.\\d+') AS INTEGER) AS has_ip_url,
      CAST(len(string_split(lower(urls), 'http')) - 1 AS INTEGER) AS url_count,
      CAST({_any('lower(sender_email)', fv.TRAINING_FREE_PROVIDERS)} AS INTEGER) AS has_free_sender
      FROM training""")
    s["class_weights"] = _sql([MAIL, TRAINING], f"""SELECT label, n_rows,
      {_round('CAST((SELECT count(*) FROM training) AS DOUBLE) / (2 * n_rows)', 6, 9)} AS weight
      FROM (SELECT label, count(*) AS n_rows FROM training GROUP BY label)""")
    s["ngram_vocabulary"] = _sql([MAIL, TRAINING, TEXTS], f"""SELECT term, CAST(count(*) AS BIGINT) AS n_uses,
      count(DISTINCT id) AS n_docs FROM (
        SELECT id, unnest(w) AS term FROM words UNION ALL
        SELECT id, w[i] || ' ' || w[i + 1] FROM (SELECT id, w, unnest(range(1, len(w))) AS i FROM words))
      GROUP BY term ORDER BY n_uses DESC, term LIMIT {fv.MAX_FEATURES}""".replace(
        "FROM words", "FROM (SELECT id, regexp_extract_all(lower(classic), '[\\p{L}\\p{N}_]{2,}') AS w FROM texts)"))
    predicted = [MAIL, RAW_LINES, _parts("lines"), JUDGED]
    s["url_predictions"] = _sql(predicted, """SELECT url, 1 AS y_true,
      CAST(least(100, points) AS DOUBLE) AS url_score, CASE WHEN points >= 40 THEN 1 ELSE 0 END AS y_pred
      FROM judged""")
    labelled = f"""labelled AS (SELECT unnest(string_split(urls_joined, ' ')) AS url, {v.LABEL_SQL} AS y_true
      FROM mail)"""
    s["labelled_urls_csv"] = _sql([MAIL, labelled, _parts("(SELECT url FROM labelled WHERE url <> '')"), JUDGED],
                                  """SELECT y_true, CASE WHEN points >= 40 THEN 1 ELSE 0 END AS y_pred,
      count(*) AS n FROM labelled JOIN judged USING (url) GROUP BY ALL""")
    s["binary_metrics"] = _metrics("(SELECT toxic AS y_true, 1 - quality AS y_pred FROM labels)")
    s["url_benchmark_metrics"] = _sql(
        [MAIL, RAW_LINES, GOOD, testset, _parts("testset"), JUDGED],
        _metrics("(SELECT y_true, CASE WHEN points >= 40 THEN 1 ELSE 0 END AS y_pred"
                 " FROM testset JOIN judged USING (url))"))
    share = "length(regexp_replace(chunk, '[^!]+', '', 'g')) / CAST(length(chunk) AS DOUBLE)"
    s["function_text_scores"] = _sql([MAIL, CLEAN_WHOLE, CHUNKS], f"""SELECT m.email_id,
      coalesce({_round('p * 100')}, 0) AS text_score, CAST(coalesce(n, 0) AS INTEGER) AS chunk_count,
      CASE WHEN n > 0 THEN 'transformer' END AS text_mode FROM merged m LEFT JOIN (SELECT email_id,
      max(1 / (1 + exp(1 - 40 * {share}))) AS p, count(*) AS n FROM chunks GROUP BY email_id) USING (email_id)""")
    s["stream_latest_log"] = _sql([*FINGERPRINTS, PAGE_VISITS], """SELECT tab, seq, ts_us, page_id, fingerprint
      FROM (SELECT *, row_number() OVER (PARTITION BY tab ORDER BY ts_us DESC, seq DESC) AS n FROM page_visits)
      WHERE n = 1""")
    s["stream_changes"], s["stream_alerts"] = s["capture_changes"], s["alerts_deduped"]
    s["stream_latest"] = s["latest_verdict"]
    # What the watermark has passed at the end.
    s["stream_changes_late"] = s["capture_changes"] + """
      AND ts_us <= (SELECT epoch_us(date_trunc('milliseconds', max(ts))) FROM events) - 172800000000"""
    # A burst is over when its last event plus the gap is not after the watermark.
    s["stream_debounce"] = s["debounced_captures"].replace(
        "WHERE n IS NULL OR n - ts >= INTERVAL 30 MINUTE",
        """WHERE (n IS NULL OR n - ts >= INTERVAL 30 MINUTE) AND ts + INTERVAL 30 MINUTE
        <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL 10 SECOND""")
    from_json = """mail AS (SELECT email_id, raw->>'$.sender_email' AS sender_email,
        raw->>'$.sender_name' AS sender_name, raw->>'$.subject' AS subject,
        raw->>'$.body_text' AS body_text, array_to_string(raw->>'$.urls[*]', ' ') AS urls_joined,
        array_to_string(raw->>'$.attachments[*].filename', ' ') AS files_joined
      FROM objects JOIN complaints USING (email_id) WHERE errors = '')"""
    # The inner mail view is renamed: the scored mails are the ones inside the JSON.
    named = [c.replace("mail AS (", "source_mail AS (", 1) if c == MAIL else
             c.replace("FROM mail", "FROM source_mail") for c in INTAKE]
    s["stream_scores"] = _sql([*named, from_json, *INDICATOR_CHAIN], """
      SELECT email_id, risk_score, reasons FROM verdicts
      UNION ALL SELECT email_id, NULL, errors FROM complaints WHERE errors <> ''""")
    s["intake_published"] = f"""SELECT email_id, errors FROM ({s['intake_errors']})
      UNION ALL SELECT email_id, '' FROM ({s['intake_valid']})"""
    s["raw_emails_file"] = f"SELECT errors, count(*) AS n FROM ({s['intake_errors']}) GROUP BY ALL"
    s["pages_file"] = f"SELECT email_id, sender_email, subject, body_md5 FROM ({s['pages_to_emails']})"
    s["eval_template_csv"] = _sql([MAIL, RAW_LINES], """SELECT url, 1 AS y_true, CAST(NULL AS INTEGER) AS y_pred
      FROM lines""")
    s["metrics_json"] = s["binary_metrics"]
    s["shuffled_rows"] = _sql([MAIL, TRAINING], """SELECT id, label,
      row_number() OVER (ORDER BY md5('42' || id), id) - 1 AS place FROM training""")
    s["permuted_rows"] = _permuted("documents", "doc_id")
    vocabulary = s["ngram_vocabulary"].replace(f"LIMIT {fv.MAX_FEATURES}", "LIMIT 300")
    s["tfidf_features"] = _sql([MAIL, TRAINING, TEXTS, f"vocabulary AS ({vocabulary})", """words AS (SELECT id,
      regexp_extract_all(lower(classic), '[\\p{L}\\p{N}_]{2,}') AS w FROM texts)""", """uses AS (
      SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(w) AS term FROM words UNION ALL
        SELECT id, w[i] || ' ' || w[i + 1] FROM (SELECT id, w, unnest(range(1, len(w))) AS i FROM words))
      GROUP BY id, term)""", """weighed AS (SELECT id, place, tf * (ln((1.0 + (SELECT count(*) FROM texts))
        / (1.0 + n_docs)) + 1) AS x FROM uses JOIN (SELECT term, n_docs,
        row_number() OVER (ORDER BY n_uses DESC, term) AS place FROM vocabulary) USING (term))"""],
                               """SELECT id, count(place)::INTEGER AS n_terms,
      round(coalesce(max(x) / sqrt(sum(x * x)), 0), 6) AS largest,
      round(coalesce(sum(x * place) / sqrt(sum(x * x)), 0), 4) AS by_place
      FROM texts LEFT JOIN weighed USING (id) GROUP BY id""")
    return s
