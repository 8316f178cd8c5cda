"""DuckDB SQL for the operators that SQL can express, each by a plainer way than the operator's own."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def repeats(length: int = 200) -> str:
    """Equal strings of ``length`` bytes: strings of 1, 2, 4, ... bytes are named, and two names name the string that they cover."""
    steps, size = [], 1
    while size < length:
        by = min(size, length - size)
        steps.append(f"""
    w{size + by} AS (SELECT r, p, byte, min(id) OVER (PARTITION BY a, b) AS name, id FROM (
        SELECT r, p, byte, id, name AS a, lead(name, {by}) OVER (PARTITION BY r ORDER BY p) AS b FROM w{size})),""")
        size += by
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    byte AS (SELECT r, unnest(regexp_extract_all(x, '..')) AS byte, generate_subscripts(regexp_extract_all(x, '..'), 1) AS p FROM d),
    w1 AS (SELECT r, p, byte, min(id) OVER (PARTITION BY byte) AS name, id FROM (SELECT *, row_number() OVER () AS id FROM byte)),
    {''.join(steps)}
    n AS (SELECT r, max(p) AS last FROM byte GROUP BY r),
    twice AS (SELECT r, p, byte, p <= last - {length - 1} AND count(*) OVER (PARTITION BY name, p <= last - {length - 1}) > 1 AS again
              FROM w{length} JOIN n USING (r)),
    covered AS (SELECT r, p, byte, coalesce(max(CASE WHEN again THEN p END) OVER (PARTITION BY r ORDER BY p) > p - {length}, false) AS gone FROM twice),
    runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY r ORDER BY p), false) AS opens FROM covered),
    t AS (SELECT r, count(*) AS n, count(*) FILTER (WHERE gone) AS removed, count(*) FILTER (WHERE opens) AS spans,
                 string_agg(byte, '' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM runs GROUP BY r)
    SELECT doc_id, coalesce(n, 0) AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
           sha256(unhex(coalesce(kept, ''))) AS kept_sha256
    FROM d LEFT JOIN t USING (r)"""


def near_groups(words: int = 3, t: int = 90) -> str:
    """Shared shingles of all pairs that share any, and the closure of the links."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return rf"""
    WITH RECURSIVE d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
                                 ELSE list_distinct(list_transform(range(1, len(w) - {words} + 2), lambda i: {shingle})) END AS g FROM d),
    g AS (SELECT r, len(g) AS n, unnest(g) AS gram FROM s),
    links AS (SELECT a.r AS u, b.r AS v FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r AND 100 * least(a.n, b.n) >= {t} * greatest(a.n, b.n)
              GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= {t} * (a.n + b.n - count(*))),
    reach(r, other) AS (SELECT r, r FROM s UNION SELECT reach.r, links.v FROM reach JOIN links ON reach.other = links.u),
    low AS (SELECT reach.r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.other GROUP BY reach.r)
    SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id FROM s JOIN low USING (r)"""


def variants(noise: int = 199, length: int = 6, times: int = 5, factor: int = 5) -> str:
    """Words with one code point left out meet: at the same place (replaced), or with the whole of another (inserted)."""
    return rf"""
    WITH RECURSIVE crc AS (
        SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                    ORDER BY k) AS tab FROM range(256) x(k)),
    run AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
            FROM documents),
    own AS (SELECT doc_id, run, count(*) AS n FROM run WHERE length(run) >= {length} GROUP BY doc_id, run),
    bytes AS (SELECT run, n, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':', ''), lambda c: CAST(unicode(c) AS BIGINT)) || flatten(
                  list_transform(string_split(run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)]
                                                                  ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END)) AS b FROM own),
    hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, b),
                   lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) AS h FROM bytes, crc),
    left_ AS (SELECT CASE WHEN h % {noise} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
    words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM left_ WHERE length(word) >= {length} GROUP BY word HAVING sum(n) >= {times}),
    cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, 1 + length(word)) x(i)),
    near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
             UNION SELECT a.word, b.word, b.n FROM cut b JOIN words a ON b.rest = a.word
             UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word),
    best AS (SELECT word, count(*) AS n_near, arg_max(other, (other_n, -place)) AS form, max(other_n) AS form_n
             FROM (SELECT *, row_number() OVER (ORDER BY other) AS place FROM near) GROUP BY word),
    forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {factor} * w.n THEN form END AS form,
                     CASE WHEN form_n >= {factor} * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)),
    chain(word, reached) AS (SELECT word, word FROM forms UNION ALL SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.reached WHERE forms.form IS NOT NULL),
    last AS (SELECT chain.word, chain.reached AS root FROM chain JOIN forms ON forms.word = chain.reached WHERE forms.form IS NULL)
    SELECT word, form, root, n, n_near, form_n FROM forms JOIN last USING (word)"""


#: Five hex digits of the SHA-1 are four digits of base 32.
ARCHIVE = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
    h AS (SELECT *, sha1(html) AS x FROM p)
    SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
           array_to_string(list_transform(range(0, 32), lambda k: substr('{_UPPER}234567',
               CAST(1 + ((CAST('0x' || substr(x, CAST(k // 4 * 5 + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - k % 4 * 5 AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
           CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> first THEN first END AS refers_to
    FROM h"""
