"""SQL counterparts of the named queries, in the dialect of DuckDB, over the same whole tables."""

from __future__ import annotations

from mention_pulse.plans.adapters import LEXICON, N_TICKERS
from mention_pulse.plans.queries import COMPARED, DAY, END, MONTH, OTHER, START, TICKER, TOP_RECENT
from mention_pulse.schemas import COUNTERS

NUMS = ", ".join(COUNTERS)
SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in COUNTERS)

SENTIMENT = """CASE WHEN event_type IN ('purchase', 'signup') THEN 'POSITIVE'
    WHEN event_type = 'error' THEN 'NEGATIVE' ELSE 'NEUTRAL' END"""

# mentions: one row per event and tracked tag
MENTIONS = f"""
tagged AS (
  SELECT event_id, user_id, ts, {SENTIMENT} AS sentiment,
    unnest(list_distinct(CASE WHEN event_id % 4 = 0
      THEN ['T' || (user_id % 20), 'T' || (event_id % 30)] ELSE ['T' || (user_id % 20)] END)) AS tag
  FROM events),
mentions AS (
  SELECT event_id AS tweet_id, user_id AS author_id, ts, sentiment, tag AS ticker,
    n_name AS ticker_name, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
    strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
    CAST(ts AS VARCHAR) || '.' || right(CAST(event_id AS VARCHAR), 10) AS stamp
  FROM tagged JOIN nation ON tag = 'T' || n_nationkey WHERE n_nationkey + 1 <= {N_TICKERS})"""

COUNT_CLASSES = """count(*) AS NUM_MENTIONS,
    count(*) FILTER (WHERE sentiment = 'POSITIVE') AS NUM_POSITIVE,
    count(*) FILTER (WHERE sentiment = 'NEGATIVE') AS NUM_NEGATIVE,
    count(*) FILTER (WHERE sentiment = 'NEUTRAL') AS NUM_NEUTRAL"""

LEVEL = """CASE grouping(month) + grouping(day) + grouping(hour)
    WHEN 3 THEN 'YEARLY' WHEN 2 THEN 'MONTHLY' WHEN 1 THEN 'DAILY' ELSE 'HOURLY' END"""


def _rollup(source: str) -> str:
    return f"""
  SELECT concat_ws('-', year, month, day, hour) AS DetailLevel, ticker AS TICKER,
    ticker || '_' || {LEVEL} AS TickerDetail, min(stamp) AS TIMESTAMP, {COUNT_CLASSES}
  FROM {source} GROUP BY GROUPING SETS ((ticker, year), (ticker, year, month),
    (ticker, year, month, day), (ticker, year, month, day, hour))"""


def _metrics(source: str) -> str:
    return f"""
  SELECT concat_ws('-', year, month, day, hour) AS DetailLevel, {LEVEL} AS LEVEL, {COUNT_CLASSES}
  FROM {source}
  GROUP BY GROUPING SETS ((year), (year, month), (year, month, day), (year, month, day, hour))"""


ROLLUP = f"{MENTIONS}, rollup_ AS ({_rollup('mentions')})"
METRICS = f"{MENTIONS}, metrics AS ({_metrics('mentions')})"
PREVIOUS = f"""{METRICS}, previous AS (SELECT *, {", ".join(
    f"coalesce(lead({c}) OVER (PARTITION BY LEVEL ORDER BY DetailLevel DESC), 0) AS D_{c}"
    for c in COUNTERS)} FROM metrics)"""
# what the second write of a batch holds
REWRITTEN = "hour <> '07' AND tweet_id % 4 > 0"
RATIOS = ", ".join(f"{c} / NUM_MENTIONS AS {c}_R" for c in COUNTERS[1:])
SEEN = "substr(TIMESTAMP, 1, 19) AS FIRST_SEEN"


def _clean(column: str, url: str = "(http.+) ") -> str:
    """The five cleaning steps, one by one."""
    out = f"regexp_replace({column}, '{url}', ' ', 'g')"
    for pattern, by in (("[@|#|$]\\w+", ""), ("[^a-zA-Z0-9 -]", " "), ("^\\s|\\s+", " ")):
        out = f"regexp_replace({out}, '{pattern}', '{by}', 'g')"
    return f"trim({out})"


RECENT = f"""{MENTIONS}, recent AS (
  SELECT CAST(m.tweet_id % 5 AS VARCHAR) AS PARTITION, stamp AS TIMESTAMP,
    CAST(tweet_id AS VARCHAR) AS ID, ticker AS TICKER, sentiment AS SENTIMENT, text AS TEXT,
    {_clean("text")} AS CLEANTEXT
  FROM mentions m JOIN documents ON doc_id = tweet_id % (SELECT count(*) FROM documents))"""
NEWEST = "ORDER BY TIMESTAMP DESC, TICKER DESC, ID DESC"

KEY = "tweet_text_clean_sub25"
DOC_CLEAN = f"""doc_clean AS (
  SELECT doc_id AS tweet_id, {_clean("text")} AS tweet_text_clean,
    lower(substr({_clean("text")}, 1, 25)) AS {KEY} FROM documents)"""
DOC_MENTIONS = f"""{DOC_CLEAN}, doc_mentions AS (
  SELECT tweet_id, 'T' || (tweet_id % 20) AS ticker, {KEY} FROM doc_clean
  WHERE 'T' || (tweet_id % 20) IN (SELECT 'T' || n_nationkey FROM nation
    WHERE n_nationkey + 1 <= {N_TICKERS}))"""
TURN_MENTIONS = f"""turns AS (
  SELECT conv_id || '-' || turn AS tweet_id,
    unnest(list_distinct(['T' || (conv_id % 20), 'T' || (turn % 20)])) AS ticker,
    lower(substr({_clean("text")}, 1, 25)) AS {KEY} FROM conversations),
turn_mentions AS (SELECT * FROM turns WHERE ticker IN (
  SELECT 'T' || n_nationkey FROM nation WHERE n_nationkey + 1 <= {N_TICKERS}))"""

LEX = ", ".join(f"('{word}', CAST({value} AS DOUBLE))" for word, value in LEXICON)
SCORES = rf"""WITH lex(token, valence) AS (VALUES {LEX}),
tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\pL\pM]+')) AS token FROM documents),
sums AS (SELECT doc_id, sum(coalesce(valence, 0)) AS s, count(*) AS n,
    count(*) FILTER (WHERE valence > 0) AS pos, count(*) FILTER (WHERE valence < 0) AS neg
  FROM tokens LEFT JOIN lex USING (token) GROUP BY doc_id),
filled AS (SELECT doc_id, coalesce(s, 0) AS s, coalesce(n, 0) AS n, coalesce(pos, 0) AS pos,
    coalesce(neg, 0) AS neg FROM documents LEFT JOIN sums USING (doc_id))
SELECT doc_id AS tweet_id,
  CASE WHEN s > 0 THEN 'POSITIVE' WHEN s < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment,
  s / sqrt(s * s + 15.0) AS total,
  CASE WHEN n = 0 THEN 0.0 ELSE pos / n END AS positive,
  CASE WHEN n = 0 THEN 0.0 ELSE neg / n END AS negative
FROM filled"""

TAGS = r"list_distinct([upper(x) for x in regexp_extract_all({0}, '[#|$]([\pL\pN_]+)', 1)])"
EVENT_TEXT = """CASE WHEN event_type = 'view' THEN 'holding ' || props
    ELSE CASE WHEN event_type = 'purchase' THEN event_id || ' ' ELSE '' END
    || 'Buy $T' || (user_id % 20) || ' #t' || (event_id % 30) || ' ' || event_type || ' ' || props
    END"""
# own tags in order of first use; the two made-up tags may be the same
OWN_TAGS = """CASE WHEN event_type = 'view' THEN ''
    WHEN user_id % 20 = event_id % 30 THEN 'T' || (user_id % 20)
    ELSE 'T' || (user_id % 20) || ',T' || (event_id % 30) END"""
RAW = f"""raw AS (
  SELECT *, {EVENT_TEXT} AS text, {OWN_TAGS} AS own,
    CASE WHEN event_type = 'signup' THEN 'about #T' || (event_id % 25) END AS parent_text,
    CASE WHEN event_type = 'signup' THEN 'T' || (event_id % 25) END AS parent_tag,
    CASE WHEN event_type <> 'click' THEN event_type = 'error' END AS sensitive,
    NOT (event_type = 'error') AND NOT (event_type = 'view') AS relevant
  FROM events)"""
# buy and purchase weigh 2, error and about -3; a text is never without words
RAW_SCORE = """CASE event_type WHEN 'view' THEN 0.0 WHEN 'purchase' THEN 4.0 WHEN 'error' THEN -1.0
    ELSE 2.0 END"""

REPLIES = """posts AS (
  SELECT event_id AS tweet_id, 'root #' || event_type AS text, CASE WHEN event_id % 3 = 0
    AND event_id > 0 THEN CAST(floor(event_id / 2) AS BIGINT) END AS parent_id FROM events),
walk AS (
  SELECT tweet_id, parent_id AS at, 1 AS hops FROM posts WHERE parent_id IS NOT NULL
  UNION ALL
  SELECT w.tweet_id, p.parent_id, w.hops + 1 FROM walk w JOIN posts p ON p.tweet_id = w.at
  WHERE p.parent_id IS NOT NULL AND w.hops < 5),
roots AS (
  SELECT w.tweet_id, w.at AS root_id, p.text AS root_text, w.hops
  FROM walk w JOIN posts p ON p.tweet_id = w.at WHERE p.parent_id IS NULL)"""
ROOTS = f"""WITH RECURSIVE {REPLIES}
  SELECT p.tweet_id, p.parent_id, root_id, root_text, hops
  FROM posts p LEFT JOIN roots r USING (tweet_id) WHERE p.parent_id IS NOT NULL"""

# relevant posts as flagged mentions; texts are cleaned as written in EVENT_TEXT
PIPELINE = f"""{RAW}, scored AS (
  SELECT *, {RAW_SCORE} AS score, {_clean("text")} AS clean FROM raw WHERE relevant),
fanned AS (
  SELECT *, unnest(list_distinct(CASE WHEN parent_tag IS NULL
      THEN ['T' || (user_id % 20), 'T' || (event_id % 30)]
      ELSE ['T' || (user_id % 20), 'T' || (event_id % 30), parent_tag] END)) AS tag FROM scored),
matched AS (
  SELECT f.*, tag AS ticker, lower(substr(clean, 1, 25)) AS k,
    count(*) OVER (PARTITION BY event_id) AS ticker_sz
  FROM fanned f JOIN nation ON tag = 'T' || n_nationkey WHERE n_nationkey + 1 <= 20),
flagged AS (
  SELECT event_id AS tweet_id, user_id AS author_id, ticker, CAST(ticker_sz AS INTEGER) AS ticker_sz,
    CASE WHEN score > 0 THEN 'POSITIVE' WHEN score < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment,
    clean AS tweet_text_clean, parent_text IS NULL AS is_original,
    count(k) OVER (PARTITION BY k) > 1 AS possible_spam,
    strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
    strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour,
    CAST(ts AS VARCHAR) || '.' || right(CAST(event_id AS VARCHAR), 10) AS stamp
  FROM matched)"""

BEFORE_MID = "year || month || day < '20240116'"


def _of(ticker: str, level: str) -> str:
    return f"TickerDetail = '{ticker}_{level}'"


def oracle_sql() -> dict[str, str]:
    """One statement per named query."""
    compare = ", ".join(
        f"CAST(sum({c}) FILTER (WHERE TICKER = '{t}') AS BIGINT) AS {c}_{i}"
        for i, t in enumerate((TICKER, OTHER), 1)
        for c in COUNTERS
    )
    changes = ", ".join(f"{c} - D_{c} AS CHANGE_{c}" for c in COUNTERS)
    spam = "SELECT tweet_id, ticker, {key}, count({key}) OVER (PARTITION BY {key}) > {n} AS possible_spam"
    spam_post = f"""SELECT t.tweet_id, t.ticker, t.{KEY}, coalesce(n > 1, false) AS possible_spam
      FROM turn_mentions t LEFT JOIN (SELECT {KEY}, count(DISTINCT tweet_id) AS n
        FROM turn_mentions GROUP BY ALL) c ON t.{KEY} = c.{KEY}"""
    terms = f"""WITH {DOC_CLEAN}, words AS (
      SELECT unnest(string_split(lower(tweet_text_clean), ' ')) AS term FROM doc_clean)
      SELECT term, count(*) AS n FROM words WHERE term <> '' GROUP BY term"""
    return {
        # roll-ups
        "ticker_rollup": f"WITH {ROLLUP} SELECT * FROM rollup_",
        "rollup_at_day": f"""WITH {MENTIONS}
            SELECT year || '-' || month || '-' || day AS DetailLevel, ticker AS TICKER,
              ticker || '_DAILY' AS TickerDetail, min(stamp) AS TIMESTAMP, {COUNT_CLASSES}
            FROM mentions GROUP BY year, month, day, ticker""",
        "level_metrics": f"WITH {METRICS} SELECT * FROM metrics",
        "level_metrics_previous": f"WITH {PREVIOUS} SELECT * FROM previous",
        "period_change": f"""WITH {PREVIOUS} SELECT DetailLevel, LEVEL, {NUMS}, {changes}
            FROM previous WHERE DetailLevel = '{DAY}'""",
        "metrics_of_day": f"WITH {METRICS} SELECT * FROM metrics WHERE DetailLevel = '{DAY}'",
        "merge_rollup": f"WITH {ROLLUP} SELECT *, 'run2' AS RUN_ID FROM rollup_",
        "merge_metrics": f"WITH {METRICS} SELECT *, 'run2' AS RUN_ID FROM metrics",
        "union_runs": f"""WITH {MENTIONS},
            old AS (SELECT * FROM mentions WHERE {BEFORE_MID}),
            new AS (SELECT * FROM mentions WHERE NOT ({BEFORE_MID})),
            both_ AS ({_metrics("new")} UNION ALL {_metrics("old")})
            SELECT *, 'run2' AS RUN_ID FROM both_""",
        "replace_days": f"WITH {ROLLUP} SELECT * FROM rollup_",
        "metrics_of_rollup": f"WITH {METRICS} SELECT * FROM metrics",
        "upsert": f"""WITH {MENTIONS},
            first_ AS (SELECT * FROM mentions WHERE {BEFORE_MID}),
            second_ AS (SELECT * FROM mentions WHERE year || month || day >= '20240110'),
            runs AS (SELECT *, 'run1' AS RUN_ID FROM ({_rollup("first_")})
              UNION ALL SELECT *, 'run2' AS RUN_ID FROM ({_rollup("second_")})),
            ranked AS (SELECT *, row_number() OVER (
              PARTITION BY DetailLevel, TICKER ORDER BY RUN_ID DESC) AS nth FROM runs)
            SELECT DetailLevel, TICKER, TickerDetail, TIMESTAMP, {NUMS}, RUN_ID
            FROM ranked WHERE nth = 1""",
        "closed_days": f"""WITH {MENTIONS} SELECT year, month, day, count(*) AS n FROM mentions
            WHERE {BEFORE_MID} GROUP BY year, month, day""",
        # look-ups
        "at_level": f"WITH {ROLLUP} SELECT * FROM rollup_ WHERE DetailLevel = '{DAY}'",
        "at_level_ticker": f"""WITH {ROLLUP} SELECT * FROM rollup_
            WHERE DetailLevel = '{DAY}' AND TICKER = '{TICKER}'""",
        "leaderboard_mentions": f"""WITH {ROLLUP} SELECT *, {RATIOS} FROM rollup_
            WHERE DetailLevel = '{MONTH}' ORDER BY NUM_MENTIONS DESC, TICKER DESC LIMIT 10""",
        "leaderboard_positive": f"""WITH {ROLLUP} SELECT *, {RATIOS} FROM rollup_
            WHERE DetailLevel = '{DAY}' ORDER BY NUM_POSITIVE_R DESC, TICKER DESC LIMIT 5""",
        "trend": f"""WITH {ROLLUP} SELECT *, {SEEN} FROM rollup_
            WHERE {_of(TICKER, "HOURLY")} AND TIMESTAMP BETWEEN '{START}' AND '{END}'""",
        "trend_open_end": f"""WITH {ROLLUP} SELECT *, {SEEN} FROM rollup_
            WHERE {_of(TICKER, "DAILY")} AND TIMESTAMP > '2022-10-15 00:00:00'""",
        "trend_between_dates": f"""WITH {ROLLUP} SELECT *, {SEEN} FROM rollup_
            WHERE {_of(TICKER, "DAILY")}
              AND substr(TIMESTAMP, 1, 10) BETWEEN '2024-01-03' AND '2024-01-12'""",
        "latest_periods": f"""WITH {ROLLUP} SELECT * FROM rollup_ WHERE {_of(TICKER, "HOURLY")}
            ORDER BY TIMESTAMP DESC LIMIT 4""",
        "latest_periods_after": f"""WITH {ROLLUP} SELECT * FROM rollup_ WHERE {_of(TICKER, "DAILY")}
            AND TIMESTAMP > '2024-01-20 20:02:19.1250' ORDER BY TIMESTAMP DESC LIMIT 4""",
        "compare": f"""WITH {ROLLUP} SELECT DetailLevel, {compare} FROM rollup_
            WHERE {_of(TICKER, "DAILY")} OR {_of(OTHER, "DAILY")} GROUP BY DetailLevel""",
        "compare_between_dates": f"""WITH {ROLLUP} SELECT DetailLevel, {compare} FROM rollup_
            WHERE ({_of(TICKER, "DAILY")} OR {_of(OTHER, "DAILY")})
              AND substr(TIMESTAMP, 1, 10) BETWEEN '{COMPARED[0]}' AND '{COMPARED[1]}' GROUP BY DetailLevel""",
        "trend_stored": f"""WITH {ROLLUP} SELECT *, {SEEN} FROM rollup_
            WHERE {_of(TICKER, "HOURLY")} AND TIMESTAMP BETWEEN '{START}' AND '{END}'""",
        "at_level_stored": f"""WITH {ROLLUP} SELECT *, 'run1' AS RUN_ID FROM rollup_
            WHERE DetailLevel = '{DAY}'""",
        # sources and sinks
        "landed_day": f"""WITH {MENTIONS} SELECT tweet_id, ticker, hour FROM mentions
            WHERE year || '-' || month || '-' || day = '{DAY}'""",
        "split_tables": f"""WITH {MENTIONS} SELECT CASE WHEN tweet_id % 5 = 0 THEN 'spam' ELSE 'clean'
            END AS side, count(*) AS n, count(*) AS n_counted FROM mentions GROUP BY side""",
        "read_snapshot": f"""WITH {MENTIONS}, new AS (SELECT * FROM mentions WHERE NOT ({BEFORE_MID})),
            run AS ({_metrics("new")}) SELECT *, 'run2' AS RUN_ID FROM run""",
        "read_tickers": """SELECT CAST(n_nationkey + 1 AS INTEGER) AS sno,
            'T' || n_nationkey AS ticker, n_name AS ticker_name FROM nation""",
        "read_posts": f"WITH {RAW} SELECT event_id AS tweet_id, text, own FROM raw",
        # recent posts
        "recent_table": f"WITH {RECENT} SELECT *, 'run1' AS RUN_ID FROM recent",
        "aggregate_late": f"WITH {ROLLUP} SELECT *, 'run3' AS RUN_ID FROM rollup_",
        "rebuild_days": f"WITH {ROLLUP} SELECT *, 'run3' AS RUN_ID FROM rollup_",
        "read_recent": f"WITH {RECENT} SELECT *, 'run3' AS RUN_ID FROM recent",
        "newest_over_runs": f"""WITH {RECENT} SELECT *, 'run3' AS RUN_ID FROM recent
            WHERE TIMESTAMP BETWEEN '{START}' AND '{END}' {NEWEST} LIMIT {TOP_RECENT}""",
        "rewritten_batch": f"""WITH {MENTIONS} SELECT tweet_id, ticker, hour, tweet_id % 3 = 0 AS spam
            FROM mentions WHERE {REWRITTEN}""",
        "rebuilt_recent": f"""WITH {MENTIONS} SELECT CAST(tweet_id % 5 AS VARCHAR) AS PARTITION,
            stamp AS TIMESTAMP, CAST(tweet_id AS VARCHAR) AS ID, ticker AS TICKER, sentiment AS SENTIMENT,
            ticker AS TEXT, lower(ticker) AS CLEANTEXT, 'run2.rebuild' AS RUN_ID
            FROM mentions WHERE {REWRITTEN} AND tweet_id % 3 <> 0""",
        "rebuilt_rollup": f"""WITH {MENTIONS}, left_ AS (SELECT * FROM mentions WHERE {REWRITTEN}
            AND tweet_id % 3 <> 0), rollup_ AS ({_rollup("left_")}) SELECT *, 'run2.rebuild' AS RUN_ID FROM rollup_""",
        "compacted_rollup": f"WITH {ROLLUP} SELECT *, 'run4' AS RUN_ID FROM rollup_",
        "recent_posts": f"""WITH {RECENT} SELECT * FROM recent
            WHERE TIMESTAMP BETWEEN '{START}' AND '{END}' {NEWEST} LIMIT {TOP_RECENT}""",
        "recent_then_ticker": f"""WITH {RECENT}, top_ AS (
            SELECT * FROM recent WHERE TIMESTAMP > '2022-10-15 00:00:00' {NEWEST} LIMIT {TOP_RECENT})
            SELECT * FROM top_ WHERE TICKER = '{TICKER}'""",
        "recent_for_ticker": f"""WITH {RECENT} SELECT * FROM recent WHERE TICKER = '{TICKER}'
            AND TIMESTAMP > '2022-10-15 00:00:00' {NEWEST} LIMIT {TOP_RECENT}""",
        "recent_per_ticker": f"""WITH {RECENT}, ranked AS (SELECT *, CAST(row_number() OVER (
            PARTITION BY TICKER {NEWEST}) AS INTEGER) AS RANK FROM recent)
            SELECT * FROM ranked WHERE RANK <= 10""",
        "append_recent": f"""WITH {RECENT} SELECT *,
            CASE WHEN TIMESTAMP < '2024-01-16' THEN 'run1' ELSE 'run2' END AS RUN_ID FROM recent""",
        "class_counts": f"""WITH {RECENT} SELECT SENTIMENT, count(*) AS n_posts FROM recent
            WHERE TIMESTAMP BETWEEN '{START}' AND '{END}' GROUP BY SENTIMENT""",
        "class_totals": f"""WITH {RECENT}, top_ AS (SELECT * FROM recent
            WHERE TIMESTAMP > '2022-10-15 00:00:00' {NEWEST} LIMIT 500)
            SELECT count(*) FILTER (WHERE SENTIMENT = 'POSITIVE') AS n_positive,
              count(*) FILTER (WHERE SENTIMENT = 'NEGATIVE') AS n_negative, count(*) AS n_total
            FROM top_""",
        "ticker_choices": f"WITH {RECENT} SELECT DISTINCT TICKER FROM recent",
        "value_counts": """SELECT user_id, count(*) AS n FROM events GROUP BY user_id
            ORDER BY n DESC, user_id LIMIT 10""",
        # tags, text and spam
        "tag_mentions": (listed := f"""WITH {MENTIONS} SELECT tweet_id, ticker, ticker_name,
            string_agg(ticker, ',' ORDER BY ticker) OVER (PARTITION BY tweet_id
              ORDER BY ticker ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ticker_ls,
            CAST(count(*) OVER (PARTITION BY tweet_id) AS INTEGER) AS ticker_sz FROM mentions"""),
        "match_tickers": listed,
        "attach_posts": f"WITH {MENTIONS} SELECT tweet_id, ticker, author_id, day FROM mentions",
        "kept_posts": f"WITH {MENTIONS} SELECT count(DISTINCT tweet_id) AS kept_posts FROM mentions",
        "distinct_posts": f"WITH {MENTIONS} SELECT DISTINCT author_id, ticker FROM mentions",
        "top_tickers": """SELECT 'T' || n_nationkey AS ticker, n_name AS ticker_name FROM nation
            WHERE n_nationkey + 1 <= 10""",
        "clean_text": f"WITH {DOC_CLEAN} SELECT tweet_id, tweet_text_clean, {KEY} FROM doc_clean",
        "clean_html": f"""WITH p AS (
            SELECT page_id, html || ' see ' || url || ' or @me #tag $T1' AS t FROM pages)
            SELECT page_id, {_clean("t")} AS greedy, {_clean("t", "https?://[^ \\t\\n\\x0B\\f\\r]+")} AS token
            FROM p""",
        "flag_spam_mention": f"WITH {DOC_MENTIONS} {spam.format(key=KEY, n=1)} FROM doc_mentions",
        "flag_spam_post": f"WITH {TURN_MENTIONS} {spam_post}",
        "flag_spam_threshold": f"WITH {TURN_MENTIONS} {spam.format(key=KEY, n=2)} FROM turn_mentions",
        "spam_profile": f"""WITH {DOC_MENTIONS}, f AS ({spam.format(key=KEY, n=1)} FROM doc_mentions)
            SELECT possible_spam, count(DISTINCT tweet_id) AS n_posts FROM f GROUP BY possible_spam""",
        "term_counts": terms,
        "term_counts_top": f"{terms} ORDER BY n DESC, term LIMIT 25",
        "score_sentiment": SCORES,
        "score_by_join": SCORES,
        "ingest_by_join": f"""WITH scores AS ({SCORES}), told AS (
              SELECT *, unnest(range(CASE WHEN tweet_id % 11 = 0 AND tweet_id % 17 <> 1 THEN 2 ELSE 1 END)) AS copy,
                tweet_id % 17 = 1 AS bad, tweet_id % 7 = 3 AS textless FROM scores)
            SELECT CASE WHEN NOT bad THEN tweet_id END AS tweet_id,
              CASE WHEN bad OR textless THEN 'ProcessingFailed' ELSE 'Ok' END AS result,
              CASE WHEN NOT (bad OR textless) THEN sentiment END AS sentiment,
              CASE WHEN NOT (bad OR textless) THEN total END AS total,
              CASE WHEN NOT (bad OR textless) THEN positive END AS positive,
              CASE WHEN NOT (bad OR textless) THEN negative END AS negative,
              CASE WHEN NOT bad AND tweet_id % 5 = 0 THEN
                CASE tweet_id % 3 WHEN 0 THEN 'POSITIVE' WHEN 1 THEN 'NEGATIVE' ELSE 'NEUTRAL' END
                END AS parent_sentiment,
              CASE WHEN bad THEN 'no post ' || tweet_id END AS unread
            FROM told WHERE bad OR tweet_id % 13 <> 0""",
        "sentiment_by_lang": f"""SELECT lang, sentiment, count(*) AS n_docs,
            round(avg(positive), 9) AS avg_positive
            FROM ({SCORES}) JOIN documents ON doc_id = tweet_id GROUP BY lang, sentiment""",
        # capture and records
        "extract_tags": f"""WITH {RAW}, t AS (SELECT *,
              {TAGS.format("text")} AS found FROM raw)
            SELECT event_id AS tweet_id, own, CASE WHEN own = '' THEN coalesce(parent_tag, '')
              WHEN parent_tag IS NULL THEN own ELSE own || ',' || parent_tag END AS both
            FROM t WHERE len(found) = CASE WHEN own = '' THEN 0 ELSE len(string_split(own, ',')) END""",
        "extract_tags_html": f"""WITH t AS (
            SELECT page_id, list_sort({TAGS.format("html")}) AS found FROM pages)
            SELECT page_id, CAST(len(found) AS INTEGER) AS n_tags,
              array_to_string(found, ',') AS tags FROM t""",
        "symbol_terms": f"""SELECT unnest(['$T' || n_nationkey, '#T' || n_nationkey]) AS term
            FROM nation WHERE n_nationkey + 1 <= {N_TICKERS}""",
        "capture_filter": f"""WITH s AS (
            SELECT event_id AS tweet_id, {EVENT_TEXT} AS text, lang,
              CASE WHEN event_type = 'click' THEN 'retweeted' ELSE 'original' END AS tweet_type,
              event_type, user_id % 20 AS a, event_id % 30 AS b
            FROM events JOIN documents ON doc_id = event_id % (SELECT count(*) FROM documents))
            SELECT tweet_id, text, lang, tweet_type FROM s
            WHERE tweet_type <> 'retweeted' AND lang = 'en' AND event_type NOT IN ('error', 'view')
              AND (a IN (SELECT n_nationkey FROM nation WHERE n_nationkey + 1 <= {N_TICKERS})
                OR b IN (SELECT n_nationkey FROM nation WHERE n_nationkey + 1 <= {N_TICKERS}))""",
        "record_status": f"""WITH {RAW} SELECT event_id AS tweet_id,
            CASE WHEN relevant THEN 'Ok' ELSE 'Dropped' END AS result,
            CASE WHEN {RAW_SCORE} > 0 THEN 'POSITIVE' WHEN {RAW_SCORE} < 0 THEN 'NEGATIVE'
              ELSE 'NEUTRAL' END AS sentiment,
            CASE WHEN parent_text IS NOT NULL THEN 'NEGATIVE' END AS parent_sentiment FROM raw""",
        "keep_relevant": f"""WITH {RAW} SELECT event_id AS tweet_id, user_id AS author_id, text
            FROM raw WHERE relevant""",
        "transform_records": f"""WITH {RAW} SELECT 'r' || event_id AS recordId,
            CASE WHEN relevant THEN 'Ok' ELSE 'Dropped' END AS result, user_id AS author_id, text,
            CASE WHEN NOT relevant THEN NULL WHEN {RAW_SCORE} > 0 THEN 'POSITIVE'
              WHEN {RAW_SCORE} < 0 THEN 'NEGATIVE' ELSE 'NEUTRAL' END AS sentiment,
            CASE WHEN relevant THEN CAST({RAW_SCORE} AS DOUBLE)
              / sqrt(CAST({RAW_SCORE} AS DOUBLE) * {RAW_SCORE} + 15.0) END AS total,
            CASE WHEN parent_text IS NOT NULL THEN CAST(event_id AS VARCHAR) END AS parent_id,
            CASE WHEN relevant AND parent_text IS NOT NULL THEN
              CAST(1 AS DOUBLE) / len(regexp_extract_all(lower(parent_text), '[a-z]+')) END
              AS parent_negative FROM raw""",
        "post_type": """SELECT event_id, CASE WHEN event_type IN ('click', 'error')
            THEN 'as_' || event_type ELSE 'original' END AS tweet_type FROM events""",
        "flatten": f"""WITH {RAW} SELECT event_id AS tweet_id, user_id AS author_id, text,
            CASE WHEN event_type = 'signup' THEN 'replied_to' ELSE 'original' END
              AS tweet_meta_tweet_type, sensitive AS tweet_meta_sensitive,
            own AS tweet_meta_hashcashtags,
            CASE WHEN parent_tag IS NOT NULL THEN CAST(event_id AS VARCHAR) END
              AS reference_tweets_tweet_id,
            CASE WHEN parent_tag IS NOT NULL THEN 'original' END AS reference_tweets_tweet_type,
            parent_text AS reference_tweets_text, parent_tag AS reference_tweets_hashcashtags,
            parent_tag IS NULL AS is_original FROM raw""",
        "resolve_long": """SELECT event_id, CASE WHEN event_type <> 'view' THEN user_id END
            AS author_id FROM events""",
        "apply_mapping": """SELECT CAST(event_id AS VARCHAR) AS ID, event_type AS KIND,
            user_id AS AUTHOR FROM events""",
        "time_keys": """WITH k AS (SELECT *, CAST(ts AS VARCHAR) || '.'
              || right(CAST(event_id AS VARCHAR), 10) AS stamp FROM events)
            SELECT event_id, stamp AS TIMESTAMP, strftime(ts, '%Y-%m-%d %H:%M:%S') AS FIRST_SEEN,
              stamp AS unpacked, strftime(ts, '%Y-%m-%d-%H') AS hour_key,
              strftime(ts, '%Y-%m') AS month_key, CAST(event_id % 5 AS VARCHAR) AS PARTITION,
              event_type || '_HOURLY' AS TickerDetail FROM k""",
        # threads and whole jobs
        "resolve_root": ROOTS,
        "roots_over_landings": ROOTS,
        "with_parent": f"""WITH RECURSIVE {REPLIES}
            SELECT p.tweet_id, CAST(root_id AS VARCHAR) AS root_id,
              upper(substr(root_text, 7)) AS root_tags FROM posts p LEFT JOIN roots USING (tweet_id)""",
        "clean_posts": f"""WITH {PIPELINE} SELECT tweet_id, author_id, ticker, ticker_sz,
            sentiment AS tweet_text_sentiment, tweet_text_clean, is_original, possible_spam,
            year, month, day, hour FROM flagged""",
        "pipeline_rollup": f"""WITH {PIPELINE}, kept AS (SELECT * FROM flagged WHERE NOT possible_spam),
            r AS ({_rollup("kept")}) SELECT DetailLevel, TickerDetail, TIMESTAMP, {NUMS} FROM r""",
    }
