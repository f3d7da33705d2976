"""DuckDB counterparts of the queries that SQL can express."""

#: crc32: `bytes` as one list of numbers becomes `crc`, with the table of its 256 steps in `steps`.
CRC_STEPS = """steps AS (
            SELECT list(step ORDER BY i) AS steps FROM (
                SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step
                FROM (SELECT unnest(range(256)) AS i)))"""
CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes}),
                       lambda c, x: xor(steps[(xor(c, x) & 255) + 1], c >> 8)), 4294967295::BIGINT)"""
ID_CRC = CRC.format(bytes="list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)")
WORD_CRC = CRC.format(bytes="list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT)")
CUT_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


def _leaf(text: str) -> str:
    values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


ORACLES = {
    "op3_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM sized GROUP BY source),
        ranked AS (
            SELECT *, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST) AS place FROM sources),
        run AS (
            SELECT *, (SELECT 1.5::DOUBLE * sum(source_size) FROM sources)
                      - 2 * coalesce(sum(source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                   sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
            FROM ranked),
        level AS (
            SELECT arg_min(rest / weights, place) AS level, min(place) AS first_open
            FROM run WHERE 2.0::DOUBLE * source_size / weight >= rest / weights),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN place >= first_open THEN level * weight ELSE 2.0::DOUBLE * source_size END AS target
            FROM ranked, level),
        wanted AS (
            SELECT *, floor(target + 0.5)::BIGINT AS words FROM targets),
        ordered AS (
            SELECT s.doc_id, s.size, w.source_size, w.target,
                   CASE WHEN w.source_size = 0 THEN 0 ELSE w.words // w.source_size END AS base,
                   CASE WHEN w.source_size = 0 THEN 0 ELSE w.words % w.source_size END AS extra,
                   sum(s.size) OVER (PARTITION BY s.source ORDER BY md5('42:' || coalesce(s.doc_id::VARCHAR, ''))) - s.size AS before
            FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source)
        SELECT doc_id, size::BIGINT AS size, source_size, target,
               (size * (base + CASE WHEN 2 * (extra - before) >= size AND extra > before THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM ordered""",
    "op4_substring_dedup": r"""
        WITH split AS (
            SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        windows AS (
            SELECT doc_id, row_no, start, array_to_string(words[start:start + 49], ' ') AS run
            FROM (SELECT *, unnest(range(1, len(words) - 48)) AS start FROM split WHERE len(words) >= 50)),
        firsts AS (SELECT run, min(doc_id) AS first_id FROM windows GROUP BY run HAVING count(*) > 1),
        gone AS (
            SELECT DISTINCT row_no, unnest(range(start, start + 50)) AS place
            FROM windows JOIN firsts USING (run) WHERE doc_id > first_id),
        gone_lists AS (SELECT row_no, list(place) AS places FROM gone GROUP BY row_no),
        placed AS (
            SELECT row_no, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM split WHERE len(words) > 0),
        kept AS (
            SELECT p.row_no, string_agg(word, ' ' ORDER BY place) AS line
            FROM placed p ANTI JOIN gone USING (row_no, place) GROUP BY p.row_no)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
               sha256(coalesce(line, '')) AS kept_sha256
        FROM split LEFT JOIN gone_lists USING (row_no) LEFT JOIN kept USING (row_no)""",
    "op6_suffix_dedup": r"""
        WITH bytes AS (SELECT doc_id, row_number() OVER () AS row_no, hex(encode(coalesce(text, ''))) AS digits FROM documents),
        parts AS (
            SELECT row_no, first, substr(digits, 2 * first + 1, 2 * (2000 + 199)) AS part
            FROM (SELECT *, unnest(range(0, length(digits) // 2 - 199, 2000)) AS first FROM bytes WHERE length(digits) >= 400)),
        strings AS (
            SELECT row_no, first + start AS start, md5(substr(part, 2 * start - 1, 400)) AS string
            FROM (SELECT *, unnest(range(1, length(part) // 2 - 198)) AS start FROM parts)),
        again AS (SELECT string FROM strings GROUP BY string HAVING count(*) > 1),
        found AS (
            SELECT row_no, start, start - row_number() OVER (PARTITION BY row_no ORDER BY start) AS run FROM strings SEMI JOIN again USING (string)),
        runs AS (SELECT row_no, min(start) AS a, max(start) + 199 AS b FROM found GROUP BY row_no, run),
        reached AS (
            SELECT *, max(b) OVER (PARTITION BY row_no ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM runs),
        numbered AS (
            SELECT *, sum(CASE WHEN before IS NULL OR a > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY row_no ORDER BY a) AS span FROM reached),
        spans AS (SELECT row_no, span, min(a) AS a, max(b) AS b FROM numbered GROUP BY row_no, span),
        rests AS (
            SELECT row_no, a, b, coalesce(lag(b) OVER (PARTITION BY row_no ORDER BY a), 0) AS last_b,
                   row_number() OVER (PARTITION BY row_no ORDER BY a DESC) AS from_end FROM spans),
        kept AS (
            SELECT row_no, count(*) AS n_spans, sum(b - a + 1) AS n_removed,
                   string_agg(substr(digits, 2 * last_b + 1, 2 * (a - last_b - 1)), '' ORDER BY a)
                   || substr(max(digits), 2 * max(b) + 1) AS rest
            FROM rests JOIN bytes USING (row_no) GROUP BY row_no)
        SELECT doc_id, (length(digits) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, digits))) AS kept_sha256
        FROM bytes LEFT JOIN kept USING (row_no)""",
    "op8_decontamination": r"""
        WITH split AS (
            SELECT doc_id, row_number() OVER () AS row_no,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        phrases AS (
            SELECT DISTINCT item_id, size, array_to_string(words[start:start + size - 1], ' ') AS phrase
            FROM (SELECT *, least(len(words), 10) AS size, unnest(range(1, greatest(len(words) - 8, 2))) AS start FROM items WHERE len(words) > 0)),
        sizes AS (SELECT DISTINCT size FROM phrases),
        windows AS (
            SELECT row_no, size, start, array_to_string(words[start:start + size - 1], ' ') AS phrase
            FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS start FROM split, sizes WHERE len(words) >= size)),
        found AS (SELECT row_no, start, size, item_id FROM windows JOIN phrases USING (phrase, size)),
        hits AS (
            SELECT row_no, count(DISTINCT place) AS n_hit
            FROM (SELECT row_no, unnest(range(start, start + size)) AS place FROM found) GROUP BY row_no),
        listed AS (
            SELECT row_no, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
            FROM (SELECT DISTINCT row_no, item_id FROM found) GROUP BY row_no)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM split LEFT JOIN hits USING (row_no) LEFT JOIN listed USING (row_no)""",
    "op12_importance_resampling": f"""
        WITH {CRC_STEPS},
        docs AS (SELECT doc_id, row_number() OVER () AS row_no, {CUT_WORDS} AS words FROM documents),
        own AS (SELECT row_no, unnest(words) AS word FROM docs),
        wanted AS (SELECT unnest({CUT_WORDS}) AS word FROM benchmark),
        buckets AS (
            SELECT word, {WORD_CRC} % 10000 AS bucket
            FROM (SELECT word FROM own UNION SELECT word FROM wanted), steps),
        s AS (SELECT bucket, count(*) AS s FROM own JOIN buckets USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket),
        gains AS (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE
                   / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
            FROM s LEFT JOIN t USING (bucket)),
        sums AS (SELECT row_no, sum(gain)::BIGINT AS total FROM own JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row_no),
        weighed AS (
            SELECT doc_id, row_no, len(words)::BIGINT AS n_features,
                   CASE WHEN len(words) = 0 THEN 0
                        ELSE total // len(words) - CASE WHEN total < 0 AND total % len(words) <> 0 THEN 1 ELSE 0 END END::BIGINT AS weight,
                   ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
            FROM docs LEFT JOIN sums USING (row_no)),
        scored AS (
            SELECT *, weight + floor(-1000 * ln(-ln((h::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score FROM weighed),
        placed AS (
            SELECT row_no, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN placed USING (row_no)""",
    "op13_merkle_manifest": f"""
        WITH RECURSIVE {CRC_STEPS},
        docs AS (
            SELECT *, row_number() OVER () AS row_no, {_leaf("text")} AS leaf,
                   CASE WHEN {ID_CRC} % 3 = 0
                        THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claimed_text
            FROM documents, steps),
        claims AS (
            SELECT doc_id, row_no, leaf, coalesce('=' || lang, '-') AS tree, {_leaf("claimed_text")} AS claimed FROM docs),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS place,
                   count(*) OVER (PARTITION BY tree) AS size
            FROM claims),
        nodes AS (
            SELECT tree, 0 AS height, place, size, leaf AS node FROM leaves
            UNION ALL
            SELECT tree, height + 1, place // 8, (any_value(size) + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
            FROM nodes WHERE size > 1 GROUP BY tree, height, place // 8),
        subroots AS (
            SELECT tree, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size FROM nodes WHERE size = 1),
        upper_nodes AS (
            SELECT 0 AS height, place, size, subroot AS node FROM subroots
            UNION ALL
            SELECT height + 1, place // 8, (any_value(size) + 7) // 8, sha256(string_agg(node, '' ORDER BY place))
            FROM upper_nodes WHERE size > 1 GROUP BY height, place // 8),
        steps_up AS (
            SELECT l.row_no, n.height AS step,
                   coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place < l.place // (8::BIGINT ** n.height)::BIGINT), '') AS before,
                   coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place > l.place // (8::BIGINT ** n.height)::BIGINT), '') AS behind
            FROM leaves l JOIN nodes n ON l.tree = n.tree AND n.size > 1 AND n.place // 8 = l.place // (8::BIGINT ** (n.height + 1))::BIGINT
            GROUP BY l.row_no, n.height),
        steps_top AS (
            SELECT s.tree, n.height AS step,
                   coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place < s.place // (8::BIGINT ** n.height)::BIGINT), '') AS before,
                   coalesce(string_agg(n.node, '' ORDER BY n.place) FILTER (n.place > s.place // (8::BIGINT ** n.height)::BIGINT), '') AS behind
            FROM subroots s JOIN upper_nodes n ON n.size > 1 AND n.place // 8 = s.place // (8::BIGINT ** (n.height + 1))::BIGINT
            GROUP BY s.tree, n.height),
        paths AS (
            SELECT row_no, row_number() OVER (PARTITION BY row_no ORDER BY part, step) AS step, before, behind
            FROM (SELECT row_no, 0 AS part, step, before, behind FROM steps_up
                  UNION ALL SELECT row_no, 1, step, before, behind FROM leaves JOIN steps_top USING (tree))),
        folded AS (
            SELECT row_no, 0::BIGINT AS step, claimed AS value FROM leaves
            UNION ALL
            SELECT f.row_no, p.step, sha256(p.before || f.value || p.behind)
            FROM folded f JOIN paths p ON p.row_no = f.row_no AND p.step = f.step + 1),
        proofs AS (SELECT row_no, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof_sha256 FROM paths GROUP BY row_no),
        ends AS (SELECT row_no, arg_max(value, step) AS folded_root FROM folded GROUP BY row_no),
        root AS (SELECT node AS root FROM upper_nodes WHERE size = 1)
        SELECT doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM leaves JOIN subroots USING (tree) JOIN ends USING (row_no) LEFT JOIN proofs USING (row_no), root""",
}
