"""Comparison SQL (DuckDB) for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

from martloom.llm.mixing import REPEATS, SCHEDULES, SHARE, WEIGHTS


def _double(value: float) -> str:
    return f"({value!r}::DOUBLE)"


def _position(schedule: tuple[float, ...], share: str) -> str:
    """The place at which the area under a schedule of straight pieces reaches `share` of the whole."""
    step = 1.0 / (len(schedule) - 1)
    areas = [(a + b) / 2 * step for a, b in zip(schedule, schedule[1:], strict=False)]
    total, whens = sum(areas), []
    starts = [total]
    for area in reversed(areas):
        starts.insert(0, starts[0] - area)
    for k, area in enumerate(areas):
        s0, slope = schedule[k], (schedule[k + 1] - schedule[k]) / step
        y = f"greatest({share} * {_double(total)} - {_double(starts[k])}, 0::DOUBLE)"
        root = f"sqrt(greatest({_double(s0 * s0)} + {_double(2 * slope)} * {y}, 0::DOUBLE))"
        within = f"{_double(k * step)} + 2 * {y} / greatest({_double(s0)} + {root}, 1e-300::DOUBLE)"
        whens.append(f"WHEN {share} * {_double(total)} <= {_double(starts[k] + area)} THEN {within}")
    return f"least(greatest(CASE {' '.join(whens)} ELSE 1::DOUBLE END, 0::DOUBLE), 1::DOUBLE)"


def _copy(k: int) -> str:
    middle = f"((first + {k} * source_size + taken_{k} / 2) / greatest(quota, 1))"
    turns = " ".join(f"WHEN {n} THEN {_position(s, middle)}" for n, s in enumerate(SCHEDULES))
    return f"CASE WHEN taken_{k} > 0 THEN CASE turn {turns} END END AS position_{k}"


_TAKEN = ", ".join(
    f"greatest(least(quota - first - {k} * source_size, size), 0)::BIGINT AS taken_{k}" for k in range(REPEATS)
)

MIX = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '-' || coalesce(text, ''))) AS key FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS source_size, 2.0::DOUBLE * SUM(size)::DOUBLE AS cap FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} AS turn FROM s),
v AS (SELECT *, ({[float(x) for x in WEIGHTS]}::DOUBLE[])[turn + 1] AS weight FROM w),
l AS (
  SELECT *, (SUM(source_size) OVER () * {_double(SHARE)}
             - coalesce(SUM(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * {_double(float(REPEATS))})
            / SUM(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM v),
t AS (
  SELECT source, source_size, turn,
         least(cap, MAX(CASE WHEN level <= cap / weight THEN level END) OVER () * weight) AS target FROM l),
q AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.turn, round(t.target)::BIGINT AS quota,
         coalesce(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, {_TAKEN} FROM q),
p AS (SELECT *, {", ".join(_copy(k) for k in range(REPEATS))} FROM c)
SELECT doc_id, size, source_size, target, ({" + ".join(f"taken_{k}" for k in range(REPEATS))})::BIGINT AS taken,
       position_0 AS position, taken_0 AS taken_first, taken_1 AS taken_again, position_1 AS position_again FROM p
"""

# RE2 has no look-around. Where a kind needs a border that is not part of the match, every character that can be a
# border is written twice first: a match takes one copy on either side and leaves the other to its neighbour.
PERSONAL_DATA = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
kinds(place, kind, pattern, inside, score, least_score, context) AS (VALUES
  (1, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+', NULL, 0.9::DOUBLE, 0.0::DOUBLE,
   '\b(?:e-?mail|mail|contact|correo|courriel)\b'),
  (2, 'ip', '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+', NULL, 0.6::DOUBLE, 0.0::DOUBLE, '\b(?:ip|host|server|address|login)\b'),
  (3, 'card', '[0-9](?:[\x20-]?[0-9])+', NULL, 0.8::DOUBLE, 0.0::DOUBLE, '\b(?:card|visa|credit|karte|carte|tarjeta)\b'),
  (4, 'phone', '\+[0-9][\x20().0-9-]+[0-9]', NULL, 0.7::DOUBLE, 0.0::DOUBLE, '\b(?:phone|tel|call|mobile|fax)\b'),
  (6, 'ssn', '(?:^|[^0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?:$|[^0-9-])', '[^0-9-]', 0.4::DOUBLE, 0.6::DOUBLE,
   '\b(?:ssn|social|security)\b')),
spread AS (
  SELECT rid, place, CASE kind WHEN 'ssn' THEN regexp_replace(t, '([^0-9-])', '\1\1', 'g') ELSE t END AS t FROM docs, kinds),
cut AS (
  SELECT rid, place, kind, inside, score, least_score, context, regexp_extract_all(s.t, pattern) AS ms,
         string_split_regex(s.t, pattern) AS gs FROM spread s JOIN kinds USING (place)),
each AS (
  SELECT * EXCLUDE (ms, gs), unnest(ms) AS m, unnest(gs[:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i
  FROM cut WHERE len(ms) > 0),
-- a doubled character counts half
sized AS (
  SELECT *, CASE WHEN inside IS NULL THEN m ELSE regexp_replace(regexp_replace(m, '^' || inside, ''), inside || '$', '') END AS x,
         CASE WHEN inside IS NOT NULL AND regexp_matches(m[1], inside) THEN 0.5 ELSE 0 END AS lead,
         CASE WHEN inside IS NULL THEN length(g) ELSE (length(g) + length(regexp_replace(g, inside, '', 'g'))) / 2 END AS g_len,
         CASE WHEN inside IS NULL THEN length(m) ELSE (length(m) + length(regexp_replace(m, inside, '', 'g'))) / 2 END AS m_len
  FROM each),
placed AS (
  SELECT *, (SUM(g_len + m_len) OVER (PARTITION BY rid, place ORDER BY i) - m_len + lead)::BIGINT AS starts, x AS v FROM sized),
ended AS (SELECT *, starts + length(v) AS ends FROM placed),
near AS (
  SELECT e.*, coalesce(lag(ends) OVER (PARTITION BY rid, place ORDER BY i), 0) AS since, d.t FROM ended e JOIN docs d USING (rid)),
scored AS (
  SELECT rid, place, kind, starts, ends, v, least_score, regexp_replace(v, '[^0-9]', '', 'g') AS digits,
         least(score + CASE WHEN regexp_matches(right(lower(substring(t, since + 1, starts - since)), 48), context)
                            THEN 0.3::DOUBLE ELSE 0::DOUBLE END, 1::DOUBLE) AS score FROM near),
checked AS (
  SELECT *, CASE kind
    WHEN 'ip' THEN list_bool_and(list_transform(string_split(v, '.'), lambda p: length(ltrim(p, '0')) <= 3
                                 AND coalesce(TRY_CAST(right('0' || ltrim(p, '0'), 4) AS INTEGER), 0) <= 255))
    WHEN 'card' THEN length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1),
         lambda n: CASE WHEN n % 2 = 1 THEN ascii(reverse(digits)[n]) - 48
                        WHEN ascii(reverse(digits)[n]) - 48 > 4 THEN 2 * (ascii(reverse(digits)[n]) - 48) - 9
                        ELSE 2 * (ascii(reverse(digits)[n]) - 48) END)) % 10 = 0
    WHEN 'phone' THEN length(digits) BETWEEN 9 AND 15
    ELSE true END AS ok FROM scored),
-- Account numbers: wherever two capitals and two digits begin a word, what follows is looked at up to a word's end;
-- of its beginnings that pass the check the one of the country's length counts, or the whole.
heads AS (
  SELECT rid, unnest(ms) AS m, unnest(gs[:len(ms)]) AS g, unnest(range(1, len(ms) + 1)) AS i
  FROM (SELECT rid, regexp_extract_all(' ' || t, '[^A-Za-z0-9][A-Z]{2}[0-9]{2}') AS ms,
               string_split_regex(' ' || t, '[^A-Za-z0-9][A-Z]{2}[0-9]{2}') AS gs FROM docs) WHERE len(ms) > 0),
begun AS (
  SELECT rid, (SUM(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m))::BIGINT AS starts FROM heads),
proposed AS (
  SELECT rid, starts, regexp_extract(substring(t, starts + 1, 44), '^([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?:$|[^A-Za-z0-9])', 1) AS whole
  FROM begun JOIN docs USING (rid)),
lengths(n, countries) AS (VALUES
  (15, 'NO'), (16, 'BE'), (18, 'DK FI FO GL NL'), (19, 'MK SI'), (20, 'AT BA EE KZ LT LU XK'), (21, 'CH HR LI LV'),
  (22, 'BG BH CR DE GB GE IE ME RS VA'), (23, 'AE GI IL IQ TL'), (24, 'AD CZ ES MD PK RO SA SE SK TN VG'), (25, 'LY PT ST'),
  (26, 'IS TR'), (27, 'FR GR IT MC MR SM'), (28, 'AL AZ BY CY DO GT HU LB PL SV'), (29, 'BR EG PS QA UA'), (30, 'JO KW MU'),
  (31, 'MT SC'), (32, 'LC'), (33, 'RU')),
countries AS (SELECT n, unnest(string_split(countries, ' ')) AS country FROM lengths),
after AS (
  SELECT *, coalesce(lag(starts) OVER (PARTITION BY rid ORDER BY starts) + 4, 0) AS since FROM proposed WHERE whole <> ''),
beginnings AS (
  SELECT *, array_to_string(string_split(whole, ' ')[:words], ' ') AS v
  FROM (SELECT *, unnest(range(1, len(string_split(whole, ' ')) + 1)) AS words FROM after)),
passed AS (
  SELECT *, replace(v, ' ', '') AS plain FROM beginnings WHERE length(replace(v, ' ', '')) BETWEEN 15 AND 34
  AND list_reduce(list_transform(string_split(replace(v, ' ', '')[5:] || v[:4], ''),
       lambda c: CASE WHEN c >= 'A' THEN ascii(c) - 55 ELSE ascii(c) - 48 END),
       lambda a, n: CASE WHEN n > 9 THEN (a * 100 + n) % 97 ELSE (a * 10 + n) % 97 END, 0) = 1),
chosen AS (
  SELECT rid, starts, since, coalesce(MAX(v) FILTER (WHERE length(plain) = n),
         CASE WHEN any_value(n) IS NULL OR arg_max(v, words) = whole THEN arg_max(v, words) END) AS v
  FROM passed LEFT JOIN countries ON country = whole[:2] GROUP BY rid, starts, since, whole),
-- one that begins inside an earlier one is none
walked AS (
  SELECT rid, unnest(list_reduce(list([{'starts': starts, 'ends': starts + length(v), 'since': since}] ORDER BY starts),
         lambda a, s: CASE WHEN s[1].starts >= a[-1].ends THEN a || s ELSE a END)) AS s FROM chosen WHERE v IS NOT NULL GROUP BY rid),
accounts AS (
  SELECT rid, s.starts AS starts, s.ends AS ends,
         greatest(s.since, coalesce(lag(s.ends) OVER (PARTITION BY rid ORDER BY s.starts), 0)) AS since FROM walked),
found AS (
  SELECT rid, place, kind, starts, ends, score FROM checked WHERE ok AND score >= least_score
  UNION ALL
  SELECT rid, 5, 'iban', starts, ends,
         CASE WHEN regexp_matches(right(lower(substring(t, since + 1, starts - since)), 48),
                                  '\b(?:iban|account|bank|konto|compte|cuenta)\b') THEN 1::DOUBLE ELSE 0.9::DOUBLE END
  FROM accounts JOIN docs USING (rid)),
kept AS (
  SELECT rid, COUNT(*) FILTER (WHERE kind = 'email') AS n_email, COUNT(*) FILTER (WHERE kind = 'ip') AS n_ip,
         COUNT(*) FILTER (WHERE kind = 'card') AS n_card, COUNT(*) FILTER (WHERE kind = 'phone') AS n_phone,
         string_agg(kind || ':' || starts || ':' || ends, ',' ORDER BY place, starts) FILTER (WHERE place <= 4) AS base,
         string_agg(kind || ':' || starts || ':' || ends, ',' ORDER BY place, starts) AS spans,
         string_agg(kind || ':' || starts || ':' || score, ',' ORDER BY place, starts) AS scores
  FROM found GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(scores, '') AS scores FROM docs LEFT JOIN kept USING (rid)
"""
