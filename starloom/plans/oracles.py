"""SQL for every registered query that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

import numpy as np

RAW = """raw AS (
  SELECT o_custkey AS "user", l_partkey AS item,
         CAST((floor((l_quantity - 1) / 5) + 1) * 0.5 AS DOUBLE) AS rating,
         l_shipdate AS ts, l_orderkey AS ok, CAST(l_linenumber AS BIGINT) AS ln
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RATINGS = f"""{RAW},
ratings AS MATERIALIZED (
  SELECT "user", item, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY "user", item ORDER BY ts DESC, ok DESC, ln DESC) AS rn FROM raw)
  WHERE rn = 1)"""

MOVIES = """movies AS (
  SELECT p_partkey AS item, p_name AS title, replace(p_name, ' ', '|') || '|' || p_type AS genres, p_brand AS mpaa
  FROM part)"""

DATED = f"""{MOVIES},
dated AS (
  SELECT m.*, CASE WHEN p_size <= 45 AND f.first IS NOT NULL THEN strftime(f.first, '%Y-%m-%d') ELSE '' END AS release_date
  FROM movies m JOIN part ON p_partkey = m.item
  LEFT JOIN (SELECT l_partkey, min(l_shipdate) AS first FROM lineitem GROUP BY 1) f ON f.l_partkey = m.item)"""

TAGS = """tags AS (
  SELECT user_id AS "user", CAST(json_extract_string(props, '$.k') AS BIGINT) AS item, event_type AS tag, ts, event_id
  FROM events)"""

STREAM = """incoming AS (
  SELECT user_id AS "user", CAST(json_extract_string(props, '$.k') AS BIGINT) AS item,
         least(greatest(value, 0.5), 5.0) AS rating, ts, event_id
  FROM events)"""

SPLIT = """parts AS MATERIALIZED (
  SELECT "user", item, rating,
         (('0x' || substr(md5("user" || ':' || item), 1, 8))::BIGINT % 100) < 80 AS in_train
  FROM ratings),
train AS MATERIALIZED (SELECT "user", item, rating FROM parts WHERE in_train),
test AS MATERIALIZED (
  SELECT "user", item, rating FROM parts
  WHERE NOT in_train AND "user" IN (SELECT "user" FROM train) AND item IN (SELECT item FROM train))"""


def start(prefix: str, key: str, k: int) -> str:
    return f"(('0x' || substr(md5('{prefix}' || {key} || ':{k}'), 1, 8))::BIGINT / 4294967296.0)"


def start_table(name: str, prefix: str, key: str, source: str, rank: int = 2, letter: str = "f") -> str:
    cells = ", ".join(f"{start(prefix, key, k)} AS {letter}{k}" for k in range(rank))
    return f"{name} AS MATERIALIZED (SELECT {key}, {cells} FROM (SELECT DISTINCT {key} FROM {source}))"


def solve2(key: str, fixed: str, source: str, lam: float) -> str:
    """Rank-2 half-step in closed form over the columns f0, f1 of ``fixed``."""
    other = "item" if key == '"user"' else '"user"'
    return f"""SELECT {key}, (d * p - b * q) / (a * d - b * b) AS f0, (a * q - b * p) / (a * d - b * b) AS f1
  FROM (SELECT {key}, sum(f0 * f0) + {lam} AS a, sum(f0 * f1) AS b, sum(f1 * f1) + {lam} AS d,
               sum(rating * f0) AS p, sum(rating * f1) AS q
        FROM {source} JOIN {fixed} USING ({other}) GROUP BY {key})"""


USER = '"user"'


def solve(key: str, fixed: str, source: str, lam: float, rank: int) -> str:
    """Half-step of any rank: Gaussian elimination, one nested query per pivot."""
    other = "item" if key == '"user"' else '"user"'
    cells = [(i, j) for i in range(rank) for j in range(i, rank)]
    ridge = {True: f" + {lam}", False: ""}
    sums = [f"sum(f{i} * f{j}){ridge[i == j]} AS a{i}_{j}" for i, j in cells]
    sums += [f"sum(rating * f{i}) AS b{i}" for i in range(rank)]
    q = f"SELECT {key}, {', '.join(sums)} FROM {source} JOIN {fixed} USING ({other}) GROUP BY {key}"
    for p in range(rank - 1):
        done = [f"a{i}_{j}" for i, j in cells if i <= p] + [f"b{i}" for i in range(p + 1)]
        rest = [f"a{i}_{j} - a{p}_{i} * a{p}_{j} / a{p}_{p} AS a{i}_{j}" for i, j in cells if i > p]
        rest += [f"b{i} - a{p}_{i} * b{p} / a{p}_{p} AS b{i}" for i in range(p + 1, rank)]
        q = f"SELECT {key}, {', '.join(done + rest)} FROM ({q})"
    for i in reversed(range(rank)):
        known = "".join(f" - a{i}_{j} * f{j}" for j in range(i + 1, rank))
        q = f"SELECT *, (b{i}{known}) / a{i}_{i} AS f{i} FROM ({q})"
    return f"SELECT {key}, {', '.join(f'f{i}' for i in range(rank))} FROM ({q})"


def als(source: str, iterations: int, lam: float = 0.1, rank: int = 2) -> str:
    """Tables w1, h1, w2, h2, … of a run that starts from item vectors."""
    step = solve2 if rank == 2 else lambda *given: solve(*given, rank)
    out = [start_table("h0", "i", "item", source, rank)]
    for n in range(1, iterations + 1):
        out.append(f"w{n} AS MATERIALIZED ({step(USER, f'h{n - 1}', source, lam)})")
        out.append(f"h{n} AS MATERIALIZED ({step('item', f'w{n}', source, lam)})")
    return ",\n".join(out)


def error(source: str, n: int, rank: int = 2) -> str:
    score = " + ".join(f"w.f{k} * h.f{k}" for k in range(rank))
    return f"""(SELECT sqrt(avg(pow(rating - ({score}), 2)))
    FROM {source} JOIN w{n} w USING ("user") JOIN h{n} h USING (item))"""


def curve(iterations: range, rank: int = 2, test: bool = True) -> str:
    tested = f", round({{test}}, 6) AS test_rmse" if test else ""
    return " UNION ALL ".join(
        f"SELECT CAST({n} AS BIGINT) AS iteration, round({error('train', n, rank)}, 6) AS train_rmse"
        + tested.format(test=error("test", n, rank))
        for n in iterations
    )


def equal_cuts(blocks: int = 4) -> str:
    """Blocks of equal runs of ids, from tables user_ids and item_ids."""
    return f"""floor((du - 1) / ceil((SELECT count(*) FROM user_ids) / {blocks}.0)) AS rb,
         floor((di - 1) / ceil((SELECT count(*) FROM item_ids) / {blocks}.0)) AS cb"""


def weighed(source: str) -> str:
    """Per id the number of ratings of all smaller ids."""
    return f"""user_weights AS (SELECT "user", sum(count(*)) OVER (ORDER BY "user") - count(*) AS before_user FROM {source} GROUP BY "user"),
item_weights AS (SELECT item, sum(count(*)) OVER (ORDER BY item) - count(*) AS before_item FROM {source} GROUP BY item)"""


def rating_cuts(source: str, blocks: int = 4) -> str:
    """Blocks of about equal numbers of ratings, from the tables of ``weighed``."""
    total = f"(SELECT count(*) FROM {source})"
    return f"""CAST(before_user * {blocks} // {total} AS BIGINT) AS rb, CAST(before_item * {blocks} // {total} AS BIGINT) AS cb"""


def sgd_queue(source: str, epochs: int, blocks: int = 4, target: str = "rating", ts: str = "ts", cuts: str = "", extra: str = "") -> str:
    """Every update of a run, with its place among the updates of its user
    (uo) and of its item (io): the order is epoch, stratum, ts, ids."""
    order = f"epoch, (cb - rb + {blocks}) % {blocks}, ts, du, di"
    return f"""placed AS (
  SELECT "user", item, CAST({target} AS DOUBLE) AS rating, {ts} AS ts, du, di,
         {cuts or equal_cuts(blocks)}
  FROM {source} JOIN user_ids USING ("user") JOIN item_ids USING (item){extra}),
queue AS MATERIALIZED (
  SELECT epoch, "user", item, rating, row_number() OVER (PARTITION BY "user" ORDER BY {order}) - 1 AS uo,
         row_number() OVER (PARTITION BY item ORDER BY {order}) - 1 AS io
  FROM placed CROSS JOIN (SELECT unnest(range(1, {epochs + 1})) AS epoch))"""


# The order that seed 1 gives four strata.
SHUFFLED = np.random.default_rng(1).permutation(4).tolist()


def visits(source: str, strata: list[int]) -> str:
    """As ``sgd_queue``, with one stratum an epoch in the given order."""
    order = "epoch, du, di"
    return f"""placed AS (
  SELECT "user", item, rating, du, di, {equal_cuts(len(strata))} FROM {source} JOIN user_ids USING ("user") JOIN item_ids USING (item)),
queue AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY {order}) - 1 AS uo, row_number() OVER (PARTITION BY item ORDER BY {order}) - 1 AS io
  FROM (SELECT *, list_position({strata}, CAST((cb - rb + {len(strata)}) % {len(strata)} AS INTEGER)) AS epoch FROM placed))"""


def sgd(last: int, step: str = "0.005", lam: float = 0.01, rank: int = 4, variant: str = "plain") -> str:
    """Tables w{last}, h{last}: the state after epoch ``last``. A keyed recursion
    holds one vector per id; each round makes the updates whose user and item
    have had all their earlier updates."""
    ks = range(rank)
    low = "0.000610352 + 9 * 0.000610352 * " if variant == "implicit" else ""
    names = ", ".join(f"f{k}" for k in ks)
    by_n = {"weighted": ("/ wn", "/ hn")}.get(variant, ("", ""))
    new_h = [f"hf{k} - s * (2.0 * {lam} {by_n[1]} * hf{k} - 2.0 * e * wf{k})" for k in ks]
    against = [f"({x})" for x in new_h] if variant == "implicit" else [f"hf{k}" for k in ks]
    new_w = [f"wf{k} - s * (2.0 * {lam} {by_n[0]} * wf{k} - 2.0 * e * {against[k]})" for k in ks]
    both = ", ".join(f"w.f{k} AS wf{k}, h.f{k} AS hf{k}" for k in ks)
    product = " + ".join(f"w.f{k} * h.f{k}" for k in ks)

    def first(prefix: str, key: str) -> str:
        return ", ".join(f"{low}{start(prefix, key, k)} AS f{k}" for k in ks)

    return f"""state{last}(side, id, c, n, {names}) USING KEY (side, id) AS (
  SELECT 'u' AS side, "user" AS id, CAST(0 AS BIGINT) AS c, count(*) AS n, {first("u", USER)} FROM ratings GROUP BY "user"
  UNION ALL SELECT 'i', item, 0, count(*), {first("i", "item")} FROM ratings GROUP BY item
  UNION (
    WITH ready AS (
      SELECT "user", item, uo, io, w.n AS wn, h.n AS hn, {both}, rating - ({product}) AS e, {step} AS s
      FROM queue JOIN recurring.state{last} w ON w.side = 'u' AND w.id = "user" AND w.c = uo
                 JOIN recurring.state{last} h ON h.side = 'i' AND h.id = item AND h.c = io
      WHERE epoch <= {last})
    SELECT 'u', "user", uo + 1, wn, {", ".join(new_w)} FROM ready
    UNION ALL SELECT 'i', item, io + 1, hn, {", ".join(new_h)} FROM ready)),
w{last} AS MATERIALIZED (SELECT id AS "user", {names} FROM state{last} WHERE side = 'u'),
h{last} AS MATERIALIZED (SELECT id AS item, {names} FROM state{last} WHERE side = 'i')"""


def best(n: int, unrated: bool = False) -> str:
    """All predictions of w{n} x h{n} ranked per user."""
    skip = 'ANTI JOIN ratings r ON r."user" = w."user" AND r.item = h.item' if unrated else ""
    return f"""ranked AS (
  SELECT w."user", h.item, w.f0 * h.f0 + w.f1 * h.f1 AS predict,
         row_number() OVER (PARTITION BY w."user" ORDER BY w.f0 * h.f0 + w.f1 * h.f1 DESC, h.item) AS rank
  FROM w{n} w CROSS JOIN h{n} h {skip}
  QUALIFY rank <= 12)"""


TOP = 'SELECT "user", item, round(predict, 4) AS predict, rank FROM ranked'

CENTRED = """bias AS MATERIALIZED (SELECT "user", avg(rating) AS bias FROM ratings GROUP BY 1),
centred AS MATERIALIZED (SELECT "user", item, rating - bias AS rating FROM ratings JOIN bias USING ("user"))"""


def gd(iterations: int = 1, rate: float = 0.5, lam: float = 0.05) -> str:
    """Descent steps for items (x1, x2, …) and users (y1, y2, …) in turn."""

    def step(name: str, key: str, mine: str, users: str, items: str) -> str:
        other = "y" if key == "item" else "x"
        move = ", ".join(
            f"m.f{k} - {rate} * ({lam} * m.f{k} - coalesce(g{k}, 0) / (SELECT count(*) FROM centred)) AS f{k}" for k in (0, 1)
        )
        sums = ", ".join(f"sum((rating - (y.f0 * x.f0 + y.f1 * x.f1)) * {other}.f{k}) AS g{k}" for k in (0, 1))
        return f"""{name} AS MATERIALIZED (
  SELECT m.{key}, {move} FROM {mine} m LEFT JOIN (
    SELECT {key}, {sums} FROM centred JOIN {users} y USING ("user") JOIN {items} x USING (item) GROUP BY {key}
  ) g ON g.{key} = m.{key})"""

    out = [CENTRED, start_table("x0", "i", "item", "ratings"), start_table("y0", "u", USER, "ratings")]
    for n in range(iterations):
        out.append(step(f"x{n + 1}", "item", f"x{n}", f"y{n}", f"x{n}"))
        out.append(step(f"y{n + 1}", USER, f"y{n}", f"y{n}", f"x{n + 1}"))
    return ",\n".join(out)


def gd_mean_error(n: int) -> str:
    return f"""(SELECT avg(pow(rating - (y.f0 * x.f0 + y.f1 * x.f1), 2))
    FROM centred JOIN y{n} y USING ("user") JOIN x{n} x USING (item))"""


def gd_loss(n: int) -> str:
    return f"""round(0.5 * {gd_mean_error(n)}
  + 0.5 * 0.05 * ((SELECT sqrt(sum(f0 * f0 + f1 * f1)) FROM y{n}) + (SELECT sqrt(sum(f0 * f0 + f1 * f1)) FROM x{n})), 6)"""


DENSE = """user_ids AS (SELECT "user", row_number() OVER (ORDER BY "user") AS du FROM (SELECT DISTINCT "user" FROM ratings)),
item_ids AS (SELECT item, row_number() OVER (ORDER BY item) AS di FROM (SELECT DISTINCT item FROM ratings))"""

DENSE_RATINGS = f"""{DENSE},
dense AS MATERIALIZED (
  SELECT du AS "user", di AS item, rating, ts FROM ratings JOIN user_ids USING ("user") JOIN item_ids USING (item))"""


def tfidf(texts: str) -> str:
    return f"""t AS (SELECT id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS token FROM ({texts})),
tf AS MATERIALIZED (SELECT id, token, count(*) AS c FROM t GROUP BY ALL),
df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
n AS (SELECT count(*) AS n FROM ({texts})),
raw_w AS MATERIALIZED (SELECT id, token, c * (ln((1.0 + n) / (1.0 + df)) + 1) AS w FROM tf JOIN df USING (token) CROSS JOIN n),
len AS (SELECT id, sqrt(sum(w * w)) AS length FROM raw_w GROUP BY id),
weights AS MATERIALIZED (SELECT id, token, w / length AS weight FROM raw_w JOIN len USING (id))"""


def cosine(texts: str, n: int, self_too: bool = False) -> str:
    skip = "" if self_too else "WHERE a.id <> b.id"
    return f"""products AS (
  SELECT a.id AS id, b.id AS other, round(sum(a.weight * b.weight), 6) AS score
  FROM weights a JOIN weights b USING (token) GROUP BY 1, 2),
scores AS (
  SELECT a.id AS id, b.id AS other, coalesce(score, 0.0) AS score
  FROM ({texts}) a CROSS JOIN ({texts}) b LEFT JOIN products p ON p.id = a.id AND p.other = b.id {skip}),
best AS (SELECT id, other, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS rank FROM scores
         QUALIFY rank <= {n})"""


ITEM_TEXT = "SELECT p_partkey AS id, p_name || ' ' || p_type || ' ' || p_brand AS text FROM part"
DOC_TEXT = "SELECT doc_id AS id, text FROM documents"

FUZZY = """wanted AS (SELECT DISTINCT regexp_replace(p_name, 'e', '', 'g') AS wanted FROM part),
titles AS (SELECT DISTINCT p_name AS title FROM part),
close AS (
  SELECT wanted, title,
         round(1.0 - levenshtein(wanted, title) / greatest(length(wanted), length(title))::DOUBLE, 6) AS score
  FROM wanted CROSS JOIN titles),
matches AS (SELECT *, row_number() OVER (PARTITION BY wanted ORDER BY score DESC, title) AS rank FROM close WHERE score >= 0.6)"""

EVENT_ORDER = """x AS (
  SELECT event_id, user_id, ts, row_number() OVER (ORDER BY event_id) - 1 AS idx, count(*) OVER () AS n,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)"""

VECTOR_PRODUCT = """products AS (
  SELECT a.vec_id AS "user", b.vec_id AS item, list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS predict
  FROM embeddings a CROSS JOIN embeddings b)"""

STAR_ROWS = " UNION ALL ".join(
    f"""SELECT item, count(*) AS votes, CAST({s} AS BIGINT) AS star,
  round(100.0 * count(*) FILTER (rating = {s - 0.5}) / count(*), 2) + round(100.0 * count(*) FILTER (rating = {s}) / count(*), 2) AS ratio,
  count(*) FILTER (rating IN ({s - 0.5}, {s})) AS n FROM ratings GROUP BY item"""
    for s in range(1, 6)
)

STAR_COUNTS = ", ".join(f"count(*) FILTER (rating IN ({s - 0.5}, {s})) AS stars_{s}" for s in range(1, 6))
STAR_FILLED = ", ".join(f"coalesce(stars_{s}, 0) AS stars_{s}" for s in range(1, 6))


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _recursive(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _spelled(table: str, key: str, digits: int = 4, name: str | None = None, rank: int = 2) -> str:
    cells = ", ".join(f"round(f{k}, {digits}) AS f{k}" for k in range(rank))
    return f"SELECT {key} {f'AS {name}' if name else ''}, {cells} FROM {table}"


ORACLES: dict[str, str] = {
    "ratings_latest": _with(RATINGS) + "SELECT * FROM ratings",
    "top_rated": _with(RATINGS, MOVIES)
    + """SELECT item, title, genres, n_ratings, round(a, 6) AS avg_rating FROM movies JOIN (
  SELECT item, count(*) AS n_ratings, avg(rating) AS a FROM ratings GROUP BY item HAVING count(*) > 30
  ORDER BY a DESC, item LIMIT 12) USING (item)""",
    "item_average": _with(RATINGS) + "SELECT item, count(*) AS n_ratings, round(avg(rating), 1) AS shown FROM ratings GROUP BY item",
    "item_profile": _with(RATINGS, DATED)
    + f"""SELECT d.item, title, genres, CASE WHEN mpaa IS NULL OR mpaa = '' THEN 'HD' ELSE mpaa END AS mpaa, release_date,
  coalesce(votes, 0) AS votes, round(average, 6) AS average, {STAR_FILLED}, round(average, 1) AS shown,
  CAST(CASE WHEN average >= 4.5 THEN 5 WHEN average >= 3.5 THEN 4 WHEN average >= 2.5 THEN 3 WHEN average >= 1.5 THEN 2
       WHEN average >= 0.5 THEN 1 WHEN average >= 0 THEN 0 END AS BIGINT) AS band
FROM dated d LEFT JOIN (SELECT item, count(*) AS votes, avg(rating) AS average, {STAR_COUNTS} FROM ratings GROUP BY item) s
  ON s.item = d.item""",
    "star_histogram": _with(RATINGS) + STAR_ROWS,
    "rating_lookup": _with(RATINGS, TAGS)
    + 'SELECT "user", item, rating FROM ratings SEMI JOIN tags USING ("user", item)',
    "user_items": _with(RATINGS, TAGS) + 'SELECT "user", item, rating FROM ratings SEMI JOIN tags USING ("user")',
    "rating_stats": _with(RATINGS)
    + """SELECT count(*) AS n_ratings, count(DISTINCT "user") AS n_users, round(avg(rating), 6) AS mean_rating, max("user") AS max_user,
  (SELECT max(c) FROM (SELECT count(*) AS c FROM ratings GROUP BY "user")) AS most_by_user,
  count(DISTINCT item) AS n_items, max(item) AS max_item,
  (SELECT max(c) FROM (SELECT count(*) AS c FROM ratings GROUP BY item)) AS most_by_item FROM ratings""",
    "first_items": _with(MOVIES) + "SELECT * FROM movies ORDER BY item LIMIT 12",
    "newest_items": _with(DATED)
    + "SELECT * FROM dated WHERE release_date NOT IN ('None', '') ORDER BY release_date DESC, item LIMIT 12",
    "genre_filter": _with(MOVIES) + "SELECT * FROM movies WHERE contains(genres, 'widget')",
    "genre_members": _with(MOVIES) + "SELECT * FROM movies WHERE list_contains(string_split(genres, '|'), 'widget')",
    "items_without_genres": _with(MOVIES)
    + """SELECT m.item, title, mpaa, tmdb_id, len(string_split(genres, '|')) AS n_genres FROM movies m
JOIN (SELECT l_partkey AS item, min(l_suppkey) AS tmdb_id FROM lineitem GROUP BY 1) USING (item)""",
    "title_lookup": _with(MOVIES) + "SELECT * FROM movies WHERE title = 'red widget'",
    "items_by_key": _with(MOVIES, TAGS) + "SELECT * FROM movies SEMI JOIN tags USING (item)",
    "genre_bridge": _with(MOVIES) + "SELECT item, unnest(string_split(genres, '|')) AS genre FROM movies",
    "attribute_bridges": _with(MOVIES)
    + """SELECT item, 'genre' AS attribute, unnest(string_split(genres, '|')) AS value FROM movies
UNION ALL SELECT p_partkey, 'director', unnest([p_type, p_brand]) FROM part""",
    "struct_names": "SELECT p_partkey AS item, p_name || '|' || CASE WHEN p_size > 25 THEN p_type ELSE '' END AS names FROM part",
    "home_bundle": _with(RATINGS, DATED)
    + """SELECT 'first' AS list, item, title FROM (SELECT * FROM dated ORDER BY item LIMIT 12)
UNION ALL SELECT 'top', item, title FROM dated JOIN (
  SELECT item FROM ratings GROUP BY item HAVING count(*) > 30 ORDER BY avg(rating) DESC, item LIMIT 12) USING (item)
UNION ALL SELECT 'newest', item, title FROM (
  SELECT * FROM dated WHERE release_date NOT IN ('None', '') ORDER BY release_date DESC, item LIMIT 12)
UNION ALL SELECT 'genre', item, title FROM (SELECT * FROM dated WHERE contains(genres, 'widget') ORDER BY item LIMIT 12)""",
    "wide_items": """WITH l AS (SELECT l_partkey AS item, min(l_suppkey) AS tmdb_id, strftime(min(l_shipdate), '%Y-%m-%d') AS first
  FROM lineitem GROUP BY 1)
SELECT p_partkey AS item, p_name AS title, 'tt' || p_partkey AS imdb_id, tmdb_id, 'link' AS title_2,
  CASE WHEN p_size <= 25 THEN p_name || ' ' || p_type ELSE p_name END AS plot_summary,
  CASE WHEN p_size <= 25 THEN '' ELSE first END AS release_date,
  CASE WHEN p_size <= 25 THEN '' ELSE substr(first, 1, 4) END AS release_year,
  CASE WHEN p_size <= 25 THEN '/p/' || p_partkey ELSE '' END AS poster_path,
  CASE WHEN p_size BETWEEN 11 AND 25 THEN p_brand ELSE '' END AS mpaa,
  CASE WHEN p_size <= 25 THEN p_type || '|' || p_brand ELSE '' END AS directors,
  replace(p_name, ' ', '|') AS actors
FROM part JOIN l ON l.item = p_partkey""",
    "user_list": _with(RAW, TAGS)
    + """SELECT "user", 'user_' || "user" AS username FROM (SELECT "user" FROM raw UNION SELECT "user" FROM tags)""",
    "users_matched": _with(RAW, TAGS)
    + """SELECT coalesce(r."user", t."user") AS "user", r."user" IS NOT NULL AS rated, t."user" IS NOT NULL AS tagged
FROM (SELECT DISTINCT "user" FROM raw) r FULL JOIN (SELECT DISTINCT "user" FROM tags) t ON r."user" = t."user\"""",
    "new_user_ids": _with(RAW)
    + """SELECT (SELECT max("user") FROM raw) + row_number() OVER (ORDER BY c_name) AS "user", c_name AS username FROM customer""",
    "dense_ids": _with(RAW)
    + """SELECT "user" AS raw_id, row_number() OVER (ORDER BY "user") AS dense_id, 'user' AS side FROM (SELECT DISTINCT "user" FROM raw)
UNION ALL SELECT item, row_number() OVER (ORDER BY item) - 1, 'item' FROM (SELECT DISTINCT item FROM raw)""",
    "reindexed_ratings": _with(RATINGS, DENSE_RATINGS) + "SELECT * FROM dense",
    "ids_back": _with(RATINGS, DENSE_RATINGS, TAGS)
    + """, known AS (SELECT "user" AS raw_id, row_number() OVER (ORDER BY "user") AS dense_id FROM (SELECT DISTINCT "user" FROM tags))
SELECT d."user" AS dense, coalesce(raw_id, 0) AS "user", n
FROM (SELECT "user", count(*) AS n FROM dense GROUP BY 1) d LEFT JOIN known ON dense_id = d."user\"""",
    "kfold": _with(EVENT_ORDER) + "SELECT event_id, CAST(floor(idx * 5 / n) + 1 AS BIGINT) AS fold FROM x",
    "fold_invariants": _with(EVENT_ORDER)
    + """, f AS (SELECT event_id, floor(idx * 5 / n) + 1 AS fold FROM x)
SELECT count(*) AS n_union, count(DISTINCT event_id) AS n_ids,
  (SELECT count(*) FROM (SELECT event_id FROM f GROUP BY 1 HAVING count(DISTINCT fold) > 1)) AS n_shared,
  (SELECT count(*) FROM events ANTI JOIN f USING (event_id)) AS lost FROM f""",
    "holdout_per_user": _with(EVENT_ORDER)
    + "SELECT event_id, k BETWEEN 1 AND 10 AS in_a, k BETWEEN 11 AND 20 AS in_b FROM x",
    "holdout_capped": _with(EVENT_ORDER)
    + """, c AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS place FROM x WHERE k BETWEEN 1 AND 10)
SELECT x.event_id, coalesce(place <= 1000, false) AS in_test FROM x LEFT JOIN c ON c.event_id = x.event_id""",
    "first_ratings": _with(EVENT_ORDER) + 'SELECT event_id, user_id AS "user", k FROM x WHERE k <= 10',
    "sorted_ratings": _with(RATINGS)
    + 'SELECT "user", item, rating, row_number() OVER (ORDER BY "user", item) - 1 AS idx FROM ratings',
    "hash_split": _with(RATINGS, SPLIT) + 'SELECT "user", item, in_train FROM parts',
    "semi_filtered_test": _with(RATINGS, SPLIT, TAGS)
    + 'SELECT event_id, "user", item FROM tags SEMI JOIN train USING ("user") SEMI JOIN (SELECT DISTINCT item FROM train) USING (item)',
    "test_only_items": _with(RAW, TAGS) + 'SELECT DISTINCT "user" FROM raw ANTI JOIN tags USING ("user")',
    "cold_test_ids": _with(RATINGS)
    + " UNION ALL ".join(
        f"""SELECT CAST({percent} AS BIGINT) AS percent, '{side}' AS side, "{side}" AS id, count(*) AS n FROM ratings
WHERE NOT {hashed} < {percent} AND "{side}" NOT IN (SELECT "{side}" FROM ratings WHERE {hashed} < {percent}) GROUP BY "{side}\""""
        for percent in (5, 80)
        for side in ("user", "item")
        for hashed in ["""(('0x' || substr(md5("user" || ':' || item), 1, 8))::BIGINT % 100)"""]
    ),
    "unmapped_ids": _with(RATINGS, DENSE_RATINGS, TAGS)
    + 'SELECT "user" AS dense, count(*) AS n FROM dense WHERE "user" > (SELECT count(DISTINCT "user") FROM tags) GROUP BY 1',
    "factor_init": _with(RATINGS)
    + "SELECT \"user\", "
    + ", ".join(f"round({start('u', USER, k)}, 8) AS f{k}" for k in range(4))
    + ' FROM (SELECT DISTINCT "user" FROM ratings)',
    "scaled_init": _with(RATINGS)
    + "SELECT item, "
    + ", ".join(f"round({start('i', 'item', k)} * sqrt((SELECT avg(rating) FROM ratings) / 4), 6) AS f{k}" for k in range(4))
    + " FROM (SELECT DISTINCT item FROM ratings)",
    "implicit_init": _with(RATINGS)
    + "SELECT item, "
    + ", ".join(f"round(0.000610352 + 9 * 0.000610352 * {start('i', 'item', k)}, 9) AS f{k}" for k in range(4))
    + " FROM (SELECT DISTINCT item FROM ratings)",
    "nan_check": "SELECT count(*) AS n, count(*) FILTER (list_min(embedding::DOUBLE[]) < -0.3) AS n_nan FROM embeddings",
    "dsgd_blocks": _with(RATINGS, DENSE)
    + """SELECT "user" AS raw_id, du AS dense_id, CAST(floor((du - 1) / ceil((SELECT count(*) FROM user_ids) / 7.0)) AS BIGINT) AS block,
  'user' AS side FROM user_ids
UNION ALL SELECT item, di - 1, CAST(floor((di - 1) / ceil((SELECT count(*) FROM item_ids) / 7.0)) AS BIGINT), 'item' FROM item_ids""",
    "dsgd_stratum": _with(RATINGS, DENSE_RATINGS)
    + """, b AS (SELECT CAST(floor(("user" - 1) / ceil((SELECT count(*) FROM user_ids) / 4.0)) AS BIGINT) AS rb,
  CAST(floor((item - 1) / ceil((SELECT count(*) FROM item_ids) / 4.0)) AS BIGINT) AS cb, rating FROM dense)
SELECT rb, cb, count(*) AS n, sum(rating) AS sum_rating FROM b
WHERE (rb, cb) IN ((0, 2), (1, 0), (2, 3), (3, 1)) GROUP BY rb, cb""",
    "als_half_step": _with(RATINGS, als("ratings", 1)) + _spelled("w1", USER),
    "als_routed_step": _with(RATINGS, als("ratings", 1)) + _spelled("w1", USER),
    "als_rank2_3iter": _with(RATINGS, als("ratings", 3))
    + f"SELECT *, 'user' AS side FROM ({_spelled('w3', USER, name='id')}) UNION ALL SELECT *, 'item' FROM ({_spelled('h3', 'item', name='id')})",
    "als_curve": _with(RATINGS, SPLIT, als("train", 3)) + curve(range(1, 4)),
    "als_rank10_rmse": _with(RATINGS.replace("ratings AS", "train AS"), als("train", 2, rank=10))
    + curve(range(1, 3), rank=10, test=False),
    "dense_als_step": _with(RATINGS, start_table("h0", "i", "item", "ratings"))
    + """, g AS (SELECT sum(f0 * f0) + 0.1 * count(*) AS a, sum(f0 * f1) AS b, sum(f1 * f1) + 0.1 * count(*) AS d FROM h0),
s AS (SELECT "user", sum(rating * f0) AS p, sum(rating * f1) AS q FROM ratings JOIN h0 USING (item) GROUP BY 1)
SELECT "user", round((d * p - b * q) / (a * d - b * b), 6) AS f0, round((a * q - b * p) / (a * d - b * b), 6) AS f1 FROM s CROSS JOIN g""",
    "dense_als_rmse": _with(RATINGS, start_table("h0", "i", "item", "ratings"))
    + """, g AS (SELECT sum(f0 * f0) + 0.1 * count(*) AS a, sum(f0 * f1) AS b, sum(f1 * f1) + 0.1 * count(*) AS d FROM h0),
s AS (SELECT "user", sum(rating * f0) AS p, sum(rating * f1) AS q FROM ratings JOIN h0 USING (item) GROUP BY 1),
w AS MATERIALIZED (SELECT "user", (d * p - b * q) / (a * d - b * b) AS f0, (a * q - b * p) / (a * d - b * b) AS f1 FROM s CROSS JOIN g)
SELECT round(sqrt(avg(pow(coalesce(rating, 0) - (w.f0 * h.f0 + w.f1 * h.f1), 2))), 6) AS rmse
FROM w CROSS JOIN h0 h LEFT JOIN ratings r ON r."user" = w."user" AND r.item = h.item""",
    "pair_errors": _with(RATINGS)
    + "SELECT \"user\", item, round(pow(rating - ("
    + " + ".join(f"{start('u', USER, k)} * {start('i', 'item', k)}" for k in range(2))
    + "), 2), 6) AS error FROM ratings",
    "centred_ratings": _with(RATINGS, CENTRED) + 'SELECT "user", item, round(rating, 6) AS rating FROM centred',
    "gd_item_step": _with(RATINGS, gd()) + _spelled("x1", "item", 6),
    "gd_user_step": _with(RATINGS, gd()) + _spelled("y1", USER, 6),
    "gd_loss": _with(RATINGS, gd()) + f"SELECT {gd_loss(1)} AS loss",
    "gd_training": _with(RATINGS, gd(2))
    + " UNION ALL ".join(
        f"SELECT CAST({n} AS BIGINT) AS iteration, {gd_loss(n)} AS loss, round(sqrt({gd_mean_error(n)}), 6) AS rmse" for n in (1, 2)
    ),
    "gd_predict": _with(RATINGS, gd())
    + """SELECT "user", item, round(least(greatest(y.f0 * x.f0 + y.f1 * x.f1 + bias, 0.0), 5.0), 4) AS score
FROM ratings JOIN y1 y USING ("user") JOIN x1 x USING (item) JOIN bias USING ("user")""",
    "dsgd_epoch": _recursive(RATINGS, DENSE, sgd_queue("ratings", 1), sgd(1)) + _spelled("w1", USER, 6, rank=4),
    "dsgd_weighted": _recursive(RATINGS, DENSE, sgd_queue("ratings", 1), sgd(1, variant="weighted"))
    + _spelled("w1", USER, 6, rank=4),
    "dsgd_balanced": _recursive(
        RATINGS, DENSE, weighed("ratings"),
        sgd_queue(
            "ratings", 1, cuts=rating_cuts("ratings"),
            extra=' JOIN user_weights USING ("user") JOIN item_weights USING (item)',
        ),
        sgd(1),
    )
    + _spelled("w1", USER, 6, rank=4),
    "dsgd_balanced_blocks": _with(RAW, weighed("raw"))
    + f"""SELECT rb, cb, count(*) AS n FROM (
  SELECT {rating_cuts("raw", 7)} FROM raw JOIN user_weights USING ("user") JOIN item_weights USING (item)) GROUP BY rb, cb""",
    "dsgd_implicit": _recursive(RATINGS, DENSE, sgd_queue("ratings", 1, target="5", ts="0"), sgd(1, variant="implicit"))
    + _spelled("w1", USER, 6, rank=4),
    "dsgd_curve": _recursive(
        RATINGS, SPLIT, DENSE, sgd_queue("train", 2, ts="0"),
        *[sgd(n, step="0.005 * pow(0.9, epoch)") for n in (0, 1, 2)],
    )
    + curve(range(0, 3), rank=4),
    "dsgd_shuffled": _recursive(
        RATINGS, SPLIT, DENSE, visits("train", SHUFFLED),
        *[sgd(n, step="pow(5500 + epoch, -0.8)") for n in range(5)],
    )
    + curve(range(0, 5), rank=4),
    "grid_metrics": " UNION ALL ".join(
        f"""SELECT * FROM ({_with(RATINGS, SPLIT, als("train", 2, lam, rank))}
SELECT 'als' AS model, CAST({rank} AS BIGINT) AS rank, CAST({lam} AS DOUBLE) AS lam, CAST(0.005 AS DOUBLE) AS step,
  CAST(2 AS BIGINT) AS iterations, round({error("train", 2, rank)}, 6) AS train_rmse, round({error("test", 2, rank)}, 6) AS test_rmse)"""
        for lam in (0.1, 0.5)
        for rank in (2, 4)
    )
    + f""" UNION ALL SELECT * FROM (
{_recursive(RATINGS, SPLIT, DENSE, sgd_queue("train", 1, ts="0"), sgd(1, step="0.005 * 0.9"))}
SELECT 'sgd', 4, 0.01, 0.005, 1, round({error("train", 1, 4)}, 6), round({error("test", 1, 4)}, 6))""",
    "predict_matrix": _with(VECTOR_PRODUCT) + 'SELECT "user", item, round(predict, 5) AS predict FROM products',
    "predict_point": _with(RATINGS, als("ratings", 1), TAGS)
    + """SELECT p."user", p.item, round(coalesce(w.f0 * h.f0 + w.f1 * h.f1, 0), 4) AS score,
  round(coalesce(w.f0 * h.f0 + w.f1 * h.f1, 0), 2) AS shown
FROM (SELECT DISTINCT "user", item FROM tags) p LEFT JOIN w1 w ON w."user" = p."user" LEFT JOIN h1 h ON h.item = p.item""",
    "detail_bundle": _with(RATINGS, als("ratings", 1), TAGS)
    + """SELECT p."user", p.item, round(coalesce(w.f0 * h.f0 + w.f1 * h.f1, 0), 4) AS score, r.rating AS own_rating
FROM (SELECT DISTINCT "user", item FROM tags) p LEFT JOIN w1 w ON w."user" = p."user" LEFT JOIN h1 h ON h.item = p.item
LEFT JOIN ratings r ON r."user" = p."user" AND r.item = p.item""",
    "top_n_user": _with(RATINGS, als("ratings", 1), best(1)) + TOP,
    "top_n_unrated": _with(RATINGS, als("ratings", 3), best(3, unrated=True)) + TOP,
    "recommended_items": _with(RATINGS, als("ratings", 1), best(1), MOVIES)
    + 'SELECT "user", rank, item, title, genres FROM ranked LEFT JOIN movies USING (item)',
    "tfidf_weights": _with(tfidf(DOC_TEXT)) + "SELECT id, token, round(weight, 6) AS weight FROM weights",
    "item_tfidf": _with(tfidf(ITEM_TEXT)) + "SELECT id, token, round(weight, 6) AS weight FROM weights",
    "similar_items": _with(tfidf(ITEM_TEXT), cosine(ITEM_TEXT, 59, self_too=True)) + "SELECT * FROM best",
    "similar_documents": _with(tfidf(DOC_TEXT), cosine(DOC_TEXT, 10)) + "SELECT * FROM best",
    "similar_vectors": """WITH s AS (
  SELECT a.vec_id AS id, b.vec_id AS other,
         round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT id, other, score, row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS rank FROM s QUALIFY rank <= 10""",
    "fuzzy_titles": _with(FUZZY) + "SELECT wanted, title, score, rank FROM matches WHERE rank <= 3",
    "similar_to_title": _with(tfidf(ITEM_TEXT), cosine(ITEM_TEXT, 12), FUZZY)
    + """SELECT wanted, title, b.id, other, b.score, b.rank FROM matches m
JOIN (SELECT p_name AS title, min(p_partkey) AS id FROM part GROUP BY 1) USING (title) JOIN best b USING (id) WHERE m.rank = 1""",
    "partitioned_by_date": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, min(event_id) AS first_id,
  round(sum(value), 2) AS sum_value FROM events GROUP BY 1""",
    "trips_by_type": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
    "monthly_source_name": """SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day,
  strftime(make_date(year(o_orderdate), month(o_orderdate), 28) - INTERVAL 90 DAY, '%Y-%m') AS dashed,
  strftime(make_date(year(o_orderdate), month(o_orderdate), 28) - INTERVAL 90 DAY, '%Y_%m') AS underscored FROM orders""",
    "type_union": "SELECT event_id, event_type, value FROM events WHERE event_type = 'click'",
    "csv_round_trip": _with(RATINGS) + "SELECT \"user\", item, rating, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM ratings",
    "tab_round_trip": _with(RATINGS) + "SELECT \"user\", item, rating, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM ratings",
    "bad_rows": """SELECT count(*) FILTER (o_orderstatus <> 'P') AS good, 3.5 * count(*) FILTER (o_orderstatus <> 'P')::DOUBLE AS sum_rating,
  count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders""",
    "dimension_round_trip": """SELECT c_custkey AS id, CAST(c_nationkey AS BIGINT) AS age, substr(n_name, 1, 1) AS gender, c_mktsegment AS occupation,
  lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS zip FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "implicit_pairs": _with(RAW) + 'SELECT DISTINCT "user", item FROM raw',
    "parquet_to_csv": "SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier",
    "timestamp_load": """SELECT l_returnflag, count(*) AS n, strftime(min(l_shipdate), '%Y-%m-%d') AS first_pickup,
  strftime(max(l_shipdate) + INTERVAL 1 DAY, '%Y-%m-%d') AS last_dropoff FROM lineitem GROUP BY 1""",
    "json_factor_round_trip": """SELECT vec_id AS "user", len(embedding) AS width, round(list_sum(embedding::DOUBLE[]), 5) AS total FROM embeddings""",
    "json_document": "SELECT CAST(c_nationkey AS VARCHAR) AS key, count(*) AS value FROM customer GROUP BY 1",
    "run_snapshot": _with(RATINGS) + 'SELECT "user", item, rating FROM ratings',
    "external_table": _with(VECTOR_PRODUCT)
    + 'SELECT "user", count(*) AS n, round(max(round(predict, 5)), 4) AS best FROM products GROUP BY 1',
    "prediction_buckets": _with(RATINGS, als("ratings", 1), best(1))
    + 'SELECT "user", count(*) AS n, round(max(predict), 4) AS best FROM ranked GROUP BY 1',
    "replaced_table": _with(RAW, TAGS)
    + """SELECT 'user_' || "user" AS username FROM (SELECT "user" FROM raw UNION SELECT "user" FROM tags) CROSS JOIN range(2)""",
    "synthetic_ratings": "SELECT event_id, "
    + ", ".join(
        f"CAST(floor(('0x' || substr(md5('{name}:' || event_id), 1, 8))::BIGINT / 4294967296.0 * {n}) AS {kind}) AS {alias}"
        for name, n, kind, alias in (("user", 32, "BIGINT", USER), ("item", 16, "BIGINT", "item"), ("rating", 6, "DOUBLE", "rating"))
    )
    + " FROM events",
    "end_to_end_run": _with(RATINGS, DENSE_RATINGS, als("dense", 3))
    + """SELECT u."user", count(*) AS n, round(avg(w.f0 * h.f0 + w.f1 * h.f1), 4) AS mean, round(max(w.f0 * h.f0 + w.f1 * h.f1), 4) AS best
FROM w3 w JOIN user_ids u ON u.du = w."user" CROSS JOIN h3 h GROUP BY 1""",
    "train_job": _with(RATINGS, SPLIT, als("train", 2))
    + f"SELECT item AS movie, round(f0, 4) AS f0, round(f1, 4) AS f1, round({error('test', 2)}, 6) AS test_rmse FROM h2",
    "stream_upsert": _with(STREAM)
    + """SELECT "user", item, rating, event_id FROM incoming
QUALIFY row_number() OVER (PARTITION BY "user", item ORDER BY ts DESC, event_id DESC) = 1""",
    "stream_item_stats": _with(STREAM)
    + f"SELECT item, count(rating) AS n_ratings, round(sum(rating), 2) AS sum_rating, {STAR_COUNTS} FROM incoming GROUP BY item",
    "stream_updated_items": _with(RATINGS, STREAM)
    + f"""SELECT item, count(rating) AS n_ratings, round(sum(rating), 2) AS sum_rating, {STAR_COUNTS} FROM (
  SELECT * FROM (SELECT "user", item, rating, ts, CAST(-1 AS BIGINT) AS event_id FROM ratings UNION ALL SELECT * FROM incoming)
  QUALIFY row_number() OVER (PARTITION BY "user", item ORDER BY ts DESC, event_id DESC) = 1) GROUP BY item""",
    "tag_round_trip": _with(TAGS) + """SELECT "user", item, tag, floor(epoch(ts))::BIGINT AS seconds FROM tags""",
    "rating_upsert": _with(RATINGS, STREAM)
    + """SELECT "user", item, rating, event_id FROM (
  SELECT "user", item, rating, ts, CAST(-1 AS BIGINT) AS event_id FROM ratings UNION ALL SELECT * FROM incoming)
QUALIFY row_number() OVER (PARTITION BY "user", item ORDER BY ts DESC, event_id DESC) = 1""",
    "rating_append": _with(RAW, STREAM)
    + """SELECT "user", count(*) AS n, round(sum(rating), 2) AS sum_rating
FROM (SELECT "user", rating FROM raw UNION ALL SELECT "user", rating FROM incoming) GROUP BY 1""",
}
