"""The corpus queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm.collision import nearest
from millrace.llm.fingerprint import fingerprint_edits
from millrace.llm.minmax import near_duplicates
from millrace.llm.mixing import mix
from millrace.llm.packing import pack
from millrace.llm.page_diff import extract_main_text
from millrace.llm.periods import periodic_runs, repeat_words
from millrace.llm.secret_scan import scan_secrets, secret_digest
from millrace.llm.spelling import spelling_forms
from millrace.llm.suffixes import remove_repeats
from millrace.llm.toxicity import fit_chain, rate, toxicity_categories
from millrace.llm.url_filter import BIAS, HEX_DIGITS, Rule, SIZES, fit_url_model, judge_urls
from millrace.llm.warc import archive_folder, read_archives, write_archives
from millrace.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(prepare(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op10_minmax_near_dedup", """
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
               ELSE array_to_string(w[i:i + 4], ' ') END AS s
        FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
        WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)),
    reach AS (
        SELECT doc_id AS x, doc_id AS y FROM documents
        UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d LEFT JOIN sizes USING (doc_id)
    JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) ON x = d.doc_id""")
def op10_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85, width=5)


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)


def _spans_sql(rank: int, kind: str, pattern: str, judged: str, least: int) -> str:
    """Spans of one kind: matches and the gaps before them alternate."""
    hits, gaps = f"regexp_extract_all(t, '{pattern}')", f"regexp_split_to_array(t, '{pattern}')"
    own = f"regexp_extract_all(t, '{pattern}', {judged})"
    return f"""
        SELECT doc_id, {rank} AS rank, '{kind}' AS kind, hit, own,
               coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
               + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
        FROM (SELECT doc_id, i, hits, gaps, hits[i] AS hit, own[i] AS own
              FROM (SELECT doc_id, {hits} AS hits, {gaps} AS gaps, {own} AS own FROM texts
                    WHERE regexp_matches(t, '{pattern}')),
                   LATERAL (SELECT unnest(range(1, len(hits) + 1)) AS i))
        WHERE length(own) >= {least}"""


_ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"\x27]?\x20*[:=]\x20*[\"\x27]?"
           r"([A-Za-z0-9+/_.=-]+)")


@query("op7_trigram_secret_scan", f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    base AS ({_spans_sql(0, "assign", _ASSIGN, "2", 8)}
        UNION ALL {_spans_sql(1, "access", "AKIA[A-Z0-9]+", "0", 16)}
        UNION ALL {_spans_sql(2, "hex", "[0-9a-f]+", "0", 32)}),
    extra AS ({_spans_sql(3, "pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "0", 0)}
        UNION ALL {_spans_sql(4, "hub", "gh[pousr]_[A-Za-z0-9]{36,}", "0", 0)}),
    spans AS (SELECT doc_id, rank, kind, start, concat(kind, ':', start::BIGINT, ':', (start + length(hit))::BIGINT)
              AS span FROM (SELECT * FROM base UNION ALL SELECT * FROM extra)),
    listed AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base_spans,
               string_agg(span, ',' ORDER BY start, rank) AS spans
        FROM spans GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN listed USING (doc_id)""")
def op7_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), span=200).drop("removed")


@query("op5_document_fingerprints")
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op8_toxicity_chain")
def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = fit_chain(docs, table(spark, sf_dir, "labels"), toxicity_categories())
    return rate(docs, chain).select("doc_id", "ratings.*")


@query("op9_collision_neighbours")
def op9_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


# The tree of the mix: three domains (by the source's number), then language, then source.
DOMAINS = ("web", "reference", "forum")
MIX_WEIGHTS = {"domain": {"web": 5, "reference": 3, "forum": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}}
MIX = {"percent": 60, "epochs": 3, "seed": 42}


def source_domain() -> Column:
    number = F.regexp_extract("source", "([0-9]+)", 1).try_cast("int")
    return F.get(F.array(*map(F.lit, DOMAINS)), number % len(DOMAINS))


def _weight_sql(level: str) -> str:
    listed = MIX_WEIGHTS.get(level, {})
    return "CASE " + level + "".join(f" WHEN '{k}' THEN {v}" for k, v in listed.items()) + " ELSE 1 END" \
        if listed else "1"


def _level_sql(path: list[str], parent: str | None) -> str:
    """Water-filling of one level, as CTEs ``c_<level>``, ``r_<level>``, ``s_<level>``."""
    level, upper = path[-1], path[:-1]
    columns, family = ", ".join(path), f"PARTITION BY {', '.join(upper)}" if upper else ""
    join = " AND ".join(f"n.{u} IS NOT DISTINCT FROM p.{u}" for u in upper) or "true"
    order = f"{family} ORDER BY room::DOUBLE / w NULLS FIRST, {level} NULLS FIRST"
    return f"""
    c_{level} AS (
        SELECT {", ".join(f"n.{c}" for c in path)}, n.room, n.w, p.share
        FROM (SELECT {columns}, sum(room)::BIGINT AS room, {_weight_sql(level)} AS w FROM leaves GROUP BY {columns}) n
        JOIN {parent} p ON {join}),
    r_{level} AS (
        SELECT *, room * w_onward <= w * (share - room_before) AS is_full FROM (
            SELECT *, coalesce(sum(room) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
                      AS room_before,
                   sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS w_onward
            FROM c_{level})),
    s_{level} AS (
        SELECT {columns}, CASE WHEN is_full THEN room WHEN open_w = 0 THEN 0
                               ELSE w * (share - full_room) // open_w END AS share
        FROM (SELECT *, sum(CASE WHEN is_full THEN room ELSE 0 END) OVER ({family})::BIGINT AS full_room,
                     sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({family})::BIGINT AS open_w FROM r_{level}))"""


def _given_sql(name: str, family: str, below: str) -> str:
    """Next documents that the unused tokens of a family pay for, as CTE ``g_<name>``."""
    over = f"PARTITION BY {family}" if family else ""
    fits = "upward <= pool" if family else "upward - size < pool"
    return f"""
    g_{name} AS (
        SELECT * EXCLUDE (pool, upward) REPLACE (given OR {fits} AS given) FROM (
            SELECT *, sum(unused - CASE WHEN given THEN size ELSE 0 END) OVER ({over}) AS pool,
                   sum(CASE WHEN given THEN 0 ELSE size END) OVER ({over} ORDER BY size, domain NULLS FIRST,
                       lang NULLS FIRST, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upward
            FROM g_{below}))"""


@query("op3_source_mix", f"""
    WITH docs AS (
        SELECT doc_id, text, lang, source,
               list_extract(['web', 'reference', 'forum'],
                            TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) % 3 + 1) AS domain,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
        FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens,
                      sum(n_tokens)::BIGINT * {MIX["epochs"]} AS room FROM docs GROUP BY ALL),
    root AS (SELECT least(sum(room), sum(tokens) * {MIX["percent"]} // 100)::BIGINT AS share FROM leaves),
    {_level_sql(["domain"], "root")}, {_level_sql(["domain", "lang"], "s_domain")},
    {_level_sql(["domain", "lang", "source"], "s_lang")},
    plan AS (SELECT l.domain, l.lang, l.source, s.share // l.tokens AS whole, s.share % l.tokens AS rest
             FROM leaves l JOIN s_source s ON l.domain IS NOT DISTINCT FROM s.domain
                  AND l.lang IS NOT DISTINCT FROM s.lang AND l.source IS NOT DISTINCT FROM s.source
             WHERE l.tokens > 0),
    ranked AS (
        SELECT d.*, whole, rest, sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source ORDER BY
                   md5(concat({MIX["seed"]}, ':', whole, ':', doc_id, ':', md5(coalesce(text, ''))))
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM docs d JOIN plan p ON d.domain IS NOT DISTINCT FROM p.domain AND d.lang IS NOT DISTINCT FROM p.lang
                  AND d.source IS NOT DISTINCT FROM p.source),
    g_none AS (
        SELECT *, rest - used AS unused, next_upto - used AS size, false AS given FROM (
            SELECT domain, lang, source, any_value(rest) AS rest, min(CASE WHEN upto > rest THEN upto END) AS next_upto,
                   coalesce(max(CASE WHEN upto <= rest THEN upto END), 0) AS used
            FROM ranked WHERE rest > 0 GROUP BY domain, lang, source)),
    {_given_sql("lang", "domain, lang", "none")}, {_given_sql("domain", "domain", "lang")}, {_given_sql("root", "", "domain")}
    SELECT r.doc_id, r.domain, r.lang, r.source, r.n_tokens, epoch::INT AS epoch
    FROM ranked r LEFT JOIN g_root g ON r.domain IS NOT DISTINCT FROM g.domain AND r.lang IS NOT DISTINCT FROM g.lang
         AND r.source IS NOT DISTINCT FROM g.source,
    LATERAL (SELECT unnest(range(0, whole + CASE WHEN r.rest > 0 AND upto <= CASE WHEN given THEN next_upto ELSE g.rest END
                                            THEN 1 ELSE 0 END)) AS epoch)""")
def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every document is counted and ranked; only its row's narrow columns leave the operator here.
    drawn = mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, source_domain(), **MIX)
    return drawn.select("row.doc_id", "domain", "row.lang", "row.source", "n_tokens", "epoch")


@query("op4_warc_archives", """
    WITH pages_ AS (SELECT page_id, coalesce(html, '') AS html, encode(coalesce(html, '')) AS payload FROM pages),
    digests AS (
        SELECT page_id, octet_length(payload) AS payload_bytes, html, sha1(html) AS hex FROM pages_),
    largest AS (SELECT html, max(page_id) AS top FROM digests GROUP BY html),
    nibbles AS (
        SELECT page_id, payload_bytes, top,
               list_transform(range(1, 41), lambda i: instr('0123456789abcdef', substr(hex, i, 1)) - 1) AS d
        FROM digests JOIN largest USING (html))
    SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((d[5 * i // 4 + 1] * 16 + coalesce(d[5 * i // 4 + 2], 0)) >> (3 - i % 4)) & 31)::INT + 1, 1)), '')
           AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
    FROM nibbles""")
def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = archive_folder(spark)
    write_archives(table(spark, sf_dir, "pages"), folder, shard_bytes=16 << 20, roll_bytes=4 << 20, least=0)
    return read_archives(spark, folder).drop("url")


@query("op6_page_differencing")
def op6_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


# DuckDB has no CRC-32: its table by the usual polynomial, and the checksum of a text's bytes.
CRC_SQL = """crc_bits AS (
        SELECT i, i AS c, 0 AS k FROM range(256) t(i)
        UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
        FROM crc_bits WHERE k < 8),
    crc AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8)"""


def _crc_sql(text: str) -> str:
    return f"""xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'),
               lambda x: ('0x' || x)::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"""


@query("op11_spelling_variants", f"""
    WITH RECURSIVE {CRC_SQL},
    found AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    counted AS (SELECT doc_id, run, count(*) AS k FROM found GROUP BY ALL),
    hashed AS (SELECT run, k, {_crc_sql("concat(doc_id, ':', run)")} AS h FROM counted, crc),
    slipped AS (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
               ELSE run END AS word, k FROM hashed),
    words AS (SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
    holes AS (
        SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
    longer AS (SELECT DISTINCT h.word AS a, w.word AS b FROM holes h JOIN words w ON h.rest = w.word),
    near AS (
        SELECT a.word AS a, b.word AS b FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a, b FROM longer UNION SELECT b, a FROM longer),
    ranked AS (
        SELECT a, b, w.n, count(*) OVER (PARTITION BY a) AS n_near,
               row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place
        FROM near JOIN words w ON w.word = b),
    judged AS (
        SELECT w.word, CASE WHEN r.n >= 2 * w.n THEN b END AS form, w.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN r.n >= 2 * w.n THEN r.n END AS form_n
        FROM words w LEFT JOIN ranked r ON a = w.word AND place = 1),
    walk AS (
        SELECT word, word AS at_word, form FROM judged
        UNION ALL SELECT walk.word, j.word, j.form FROM walk JOIN judged j ON j.word = walk.form)
    SELECT j.word, j.form, at_word AS root, n, n_near, form_n
    FROM judged j JOIN walk ON walk.word = j.word AND walk.form IS NULL""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents"), letters=5, least=3, ratio=2, slip_every=97)


@query("op12_periodic_runs", f"""
    WITH RECURSIVE {CRC_SQL},
    texts AS (
        SELECT doc_id, w, len(w)::BIGINT AS n, {_crc_sql("doc_id::VARCHAR")} AS h
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents), crc),
    parts AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM texts),
    edited AS (
        SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n),
               lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM parts),
    places AS (SELECT doc_id, n, i, w[i + 1] AS word FROM edited, LATERAL (SELECT unnest(range(0, n)) AS i)),
    matches AS (
        SELECT x.doc_id, x.i, y.i - x.i AS q FROM places x
        JOIN places y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
    stretches AS (
        SELECT doc_id, q, min(i) AS start, count(*) + q AS length
        FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM matches)
        GROUP BY doc_id, q, part HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS (SELECT doc_id, start, length, min(q) AS period FROM stretches GROUP BY doc_id, start, length),
    kept AS (
        SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM places
        WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = places.doc_id AND i >= r.start + r.period
                          AND i < r.start + r.length) GROUP BY doc_id),
    listed AS (
        SELECT doc_id, count(*) AS n_runs,
               string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS all_runs
        FROM runs GROUP BY doc_id),
    best AS (
        SELECT * FROM runs r WHERE NOT EXISTS (
            SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.length * r.period > r.length * o.period
            OR (o.length * r.period = r.length * o.period AND (o.start, o.period) < (r.start, r.period)))))
    SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
           period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
           sha256(coalesce(all_runs, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
    FROM documents d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), least=24, times=3, texts=False, edit=repeat_words)
    return found.drop("runs", "collapsed")


URL_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
             Rule("allow", "org", "/fr/")]
URL_STEPS, URL_RATE, URL_RIDGE = 300, 8.0, 0.001
# Labelled by hand: advertising, tracking, gambling, pills, adult and spam sites against ordinary ones.
BLOCKED_URLS = [
    "http://ads.banner-hub.example.com/click/120", "https://www.adserver.example.org/en/33",
    "https://track-pixel.example.com/en/7.html", "http://m.click-tracker.example.net/fr/91/",
    "https://tracking-ads.example.org/de/15", "https://blog.online-casino.example.com/en/44",
    "http://casino-jackpot.example.org/es/210/", "https://www.win-casino.example.com/fr/18.html",
    "https://bets-today.example.com/en/51", "http://m.sport-bets.example.org/en/3",
    "https://free-spins.example.net/de/77", "https://www.free-money.example.com/en/19/",
    "http://cheap-meds.example.com/en/8", "https://blog.pills-shop.example.org/es/402.html",
    "https://cheap-viagra-pills.example.com/fr/5", "https://www.adult-video.example.org/en/66",
    "http://adult-chat.example.com/de/29/", "https://m.xxx-adult.example.net/en/140",
    "http://spam-links.example.com/en/2.html", "https://www.link-farm.example.org/fr/311",
    "https://seo-spam.example.com/es/58", "http://blog.content-farm.example.com/en/907/"]
ALLOWED_URLS = [
    "https://www.city-library.example.org/en/12", "http://blog.garden-notes.example.com/en/340.html",
    "https://history.example.org/fr/71/", "https://m.daily-news.example.com/en/5",
    "http://weather.example.net/de/88", "https://www.university.example.org/es/16.html",
    "https://recipes.example.com/fr/204", "http://museum-guide.example.org/en/9/",
    "https://blog.mathematics.example.com/en/31", "https://docs.example.org/en/118.html",
    "http://www.train-times.example.com/de/63", "https://therion.example.com/en/27/",
    "https://m.health-service.example.org/en/450", "http://thander.example.net/fr/39",
    "https://blog.thestin.example.org/en/6.html", "https://www.poetry.example.com/es/84",
    "http://tionand.example.com/en/101/", "https://science-journal.example.org/en/73",
    "https://m.thering.example.com/es/22", "https://parliament.example.org/de/45.html",
    "http://blog.travel-diary.example.com/en/290", "https://www.open-atlas.example.org/fr/13/",
    "https://north-shore.example.com/en/61", "http://www.southern-post.example.org/en/14.html",
    "https://blog.authors.example.com/fr/520", "https://thousand-stories.example.org/es/37/",
    "https://m.outdoors.example.com/en/8", "http://earth-history.example.org/de/91",
    "https://other-voices.example.com/es/245.html", "https://blog.storytellers.example.org/en/70",
    "https://www.orthodontist.example.com/fr/6/", "http://m.theatre.example.org/en/183",
    "https://thoughts.example.com/en/99", "https://blog.street-photos.example.com/es/12.html",
    "http://www.mountain-huts.example.org/de/308/", "https://stonework.example.com/fr/55",
    "https://m.thursday-market.example.org/es/41", "https://nutrition.example.com/en/77.html",
    "https://blog.threshold.example.org/en/202", "https://www.astronomy.example.com/es/19"]


def labelled_urls(spark: SparkSession) -> DataFrame:
    kinds = [(BLOCKED_URLS, True), (ALLOWED_URLS, False)]
    listed = [F.struct(F.lit(u).alias("url"), F.lit(k).alias("blocked")) for urls, k in kinds for u in urls]
    return spark.range(1).select(F.inline(F.array(*listed)))


def _host_path_sql(url: str) -> str:
    return f"""translate(regexp_extract(coalesce({url}, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce({url}, ''), '://[^/?#]*([^?#]*)', 1) AS path"""


def _buckets_sql(field: str, mark: str) -> str:
    plain = f"concat('{mark}', translate({field}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', " \
            f"'abcdefghijklmnopqrstuvwxyz000000000'), '{mark}')"
    cut = [f"list_transform(range(1, length({plain}) - {n} + 2), lambda i: "
           f"('0x' || substr(md5(concat('{mark}', substr({plain}, i, {n}))), 1, {HEX_DIGITS}))::INT)" for n in SIZES]
    return f"CASE WHEN length({plain}) >= {max(SIZES)} THEN list_concat({', '.join(cut)}) ELSE [] END"


_VERDICT_SQL = "".join(f" WHEN '{r.name}' THEN '{r.verdict}'" for r in URL_RULES)
_RULE_SQL = "".join(
    f" WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.name)))


@query("op13_url_filter", f"""
    WITH RECURSIVE labelled AS (
        SELECT row_number() OVER (ORDER BY url, y) AS i, y, {_host_path_sql("url")}
        FROM (VALUES {", ".join([f"('{u}', 1)" for u in BLOCKED_URLS] + [f"('{u}', 0)" for u in ALLOWED_URLS])}) v(url, y)),
    cut AS (SELECT i, y, list_distinct(list_concat({_buckets_sql("host", "^")}, {_buckets_sql("path", "|")})) AS b
            FROM labelled),
    parts AS (
        SELECT i, {BIAS} AS bucket, 1::DOUBLE AS x FROM cut
        UNION ALL SELECT i, unnest(b), 1 / sqrt(len(b)) FROM cut),
    inner_products AS (
        SELECT p.i, o.i AS j, sum(p.x * o.x) AS k FROM parts p JOIN parts o USING (bucket) GROUP BY ALL),
    lines AS (SELECT i, list(k ORDER BY j) AS line FROM inner_products GROUP BY i),
    steps AS (
        SELECT 0 AS step, i, 0::DOUBLE AS alpha FROM cut
        UNION ALL
        SELECT step + 1, c.i, alpha * (1 - {URL_RATE * URL_RIDGE}) - {URL_RATE} / (SELECT count(*) FROM cut)
               * (1 / (1 + exp(-list_dot_product(line, all_alpha))) - y)
        FROM (SELECT *, list(alpha) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
                        AS all_alpha FROM steps WHERE step < {URL_STEPS}) s
        JOIN cut c USING (i) JOIN lines USING (i)),
    model AS (SELECT bucket, sum(alpha * x) AS weight FROM parts JOIN steps USING (i) WHERE step = {URL_STEPS}
              GROUP BY bucket),
    judged AS (SELECT page_id, {_host_path_sql("url")} FROM pages),
    page_parts AS (
        SELECT page_id, host, path,
               list_distinct(list_concat({_buckets_sql("host", "^")}, {_buckets_sql("path", "|")})) AS b FROM judged),
    scored AS (
        SELECT page_id, sum(weight) / sqrt(max(len(b))) AS score
        FROM (SELECT page_id, b, unnest(b) AS bucket FROM page_parts) LEFT JOIN model USING (bucket) GROUP BY page_id)
    SELECT page_id, host, path, rule, CASE rule{_VERDICT_SQL} ELSE CASE WHEN coalesce(score, 0)
           + (SELECT weight FROM model WHERE bucket = {BIAS}) > 0 THEN 'block' ELSE 'allow' END END AS verdict
    FROM (SELECT *, CASE{_RULE_SQL} END AS rule FROM page_parts) LEFT JOIN scored USING (page_id)""")
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fit_url_model(labelled_urls(spark), URL_STEPS, URL_RATE, URL_RIDGE)
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES, model)
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
