"""Reference semantics of every registered operator as DuckDB SQL.

Each entry is plain SQL over the driver's tables: the catalog views are
prepended as CTEs (``with_views``).  The relational questions are put together
another way than the Spark plans (sub-results per film or person, RANK over rows),
so they check those independently.  Ties at a LIMIT are broken by
ids exactly as in the Spark plans.
"""

from __future__ import annotations

from reelframe.sources.catalog import with_views
from reelframe.sources.raw_views import RAW_VIEW_SQL

# Parameters of the registered queries (fixed values, chosen so each question
# is non-empty on the test tables and the formulations disagree where they should).
PARAMS = {
    "q1_name": "Supplier#000000001",
    "q2_genre": "Brand#4",
    "q2_years": (1996, 1998),
    "q2_n": 10,
    "q4_name": "Supplier#00000001",
    "q5_min_rating": 5.6,
    "q5_min_count": 1200,
    "q6_name": "Supplier#00000001",
    "q7_n": 3,
    "q8_threshold": 200,
    "q9_min_films": 10,
    "film_title": "Order 7",
    "sample_min_votes": 300,
    "needles": ["a", "Re", "part#", "re", "REd", "no such name", "a_t"],
    "zorder_bounds": ((1996, 1997), 5.5, 150),
}

P = PARAMS


def _name_has(column: str, text: str) -> str:
    """Substring test that ignores the case of A-Z only."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"contains(translate({column}, '{upper}', '{lower}'), '{text.lower()}')"


def _sql_form() -> dict[str, str]:
    """The relational questions, each from per-film or per-person sub-results."""
    y0, y1 = P["q2_years"]
    t = P["q8_threshold"]
    people = lambda name: f"(SELECT person_id FROM persons WHERE {_name_has('name', name)})"
    return {
        "q1_sql": f"""
WITH hit AS (
  SELECT movie_id, count(*) AS k FROM principals WHERE person_id IN {people(P["q1_name"])} GROUP BY movie_id),
listed AS (
  SELECT movie_id, string_agg(genre, ', ' ORDER BY genre) AS genres
  FROM (SELECT movie_id, genre, unnest(range(k)) FROM hit JOIN genres USING (movie_id)) GROUP BY movie_id)
SELECT DISTINCT primary_title AS titre, start_year AS annee, listed.genres,
  coalesce(CAST(average_rating AS VARCHAR), 'N/A') AS note
FROM hit JOIN movies USING (movie_id) LEFT JOIN listed USING (movie_id) LEFT JOIN ratings USING (movie_id)""",
        "q2_sql": f"""
WITH pool AS (
  SELECT movie_id, primary_title, start_year, average_rating, num_votes
  FROM movies JOIN ratings USING (movie_id)
  WHERE start_year BETWEEN {y0} AND {y1} AND num_votes > 0
    AND movie_id IN (SELECT movie_id FROM genres WHERE genre = '{P["q2_genre"]}')),
best AS (SELECT * FROM pool ORDER BY average_rating DESC, num_votes DESC, movie_id LIMIT {P["q2_n"]})
SELECT CAST(row_number() OVER (ORDER BY average_rating DESC, num_votes DESC, movie_id) AS INTEGER) AS rang,
  primary_title AS titre, start_year AS annee, average_rating AS note, num_votes AS votes FROM best""",
        "q3_sql": """
WITH part AS (SELECT DISTINCT movie_id, person_id, name AS role FROM characters WHERE name IS NOT NULL),
many AS (SELECT movie_id, person_id, count(*) AS nombre_roles FROM part GROUP BY ALL HAVING count(*) >= 2)
SELECT persons.name AS acteur, primary_title AS film, nombre_roles
FROM many JOIN movies USING (movie_id) JOIN persons USING (person_id)""",
        "q4_sql": f"""
WITH starred AS (SELECT DISTINCT movie_id FROM principals WHERE person_id IN {people(P["q4_name"])}),
made AS (SELECT DISTINCT person_id, movie_id FROM directors SEMI JOIN starred USING (movie_id)),
totals AS (SELECT person_id, count(*) AS nombre_films FROM made GROUP BY person_id)
SELECT name AS realisateur, nombre_films FROM totals JOIN persons USING (person_id)""",
        "q5_sql": f"""
WITH per_genre AS (
  SELECT genre, avg(average_rating) AS mean, count(*) AS nombre_films
  FROM (SELECT DISTINCT movie_id, genre, average_rating FROM genres JOIN ratings USING (movie_id)) GROUP BY genre)
SELECT genre, round(mean, 2) AS note_moyenne, nombre_films FROM per_genre
WHERE mean > {P["q5_min_rating"]} AND nombre_films > {P["q5_min_count"]}""",
        "q6_sql": f"""
WITH film AS (
  SELECT movie_id, count(*) AS k FROM principals WHERE person_id IN {people(P["q6_name"])} GROUP BY movie_id),
dated AS (
  SELECT start_year - start_year % 10 AS d, k, average_rating AS r
  FROM film JOIN movies USING (movie_id) LEFT JOIN ratings USING (movie_id))
SELECT d || 's' AS decennie, count(*) AS nombre_films,
  round(sum(r * k) / sum(k) FILTER (r IS NOT NULL), 2) AS note_moyenne
FROM dated WHERE d > 0 GROUP BY d""",
        "q7_sql": f"""
WITH picked AS (
  SELECT movie_id FROM genres JOIN ratings USING (movie_id)
  QUALIFY rank() OVER (PARTITION BY genre ORDER BY average_rating DESC) <= {P["q7_n"]})
SELECT genre, CAST(rank() OVER (PARTITION BY genre ORDER BY average_rating DESC) AS INTEGER) AS rang,
  primary_title AS titre, start_year AS annee, average_rating AS note
FROM picked JOIN genres USING (movie_id) JOIN ratings USING (movie_id) JOIN movies USING (movie_id)""",
        "q7_clean": f"""
WITH placed AS (
  SELECT genre, movie_id, average_rating, rank() OVER (PARTITION BY genre ORDER BY average_rating DESC) AS place
  FROM genres JOIN ratings USING (movie_id) QUALIFY place <= {P["q7_n"]})
SELECT genre, CAST(place AS INTEGER) AS rang, primary_title AS titre, start_year AS annee, average_rating AS note
FROM placed JOIN movies USING (movie_id)""",
        "q8_sql": f"""
WITH seen AS (
  SELECT person_id, movie_id, num_votes, average_rating, count(*) AS credits
  FROM principals JOIN ratings USING (movie_id) GROUP BY ALL),
both_sides AS (
  SELECT person_id, count(*) FILTER (num_votes <= {t}) AS low, count(*) FILTER (num_votes > {t}) AS high,
    max(num_votes) AS peak FROM seen GROUP BY person_id HAVING low > 0 AND high > 0)
SELECT acteur, films_avant, films_apres, film_percee, votes_film, note_film FROM (
  SELECT persons.name AS acteur, low AS films_avant, high AS films_apres, primary_title AS film_percee,
    num_votes AS votes_film, average_rating AS note_film, person_id, movie_id, unnest(range(credits))
  FROM both_sides JOIN seen USING (person_id) JOIN persons USING (person_id) JOIN movies USING (movie_id)
  WHERE num_votes = peak)
ORDER BY votes_film DESC, person_id, movie_id LIMIT 50""",
        "q9_sql": f"""
WITH work AS (
  SELECT DISTINCT person_id, movie_id, average_rating AS r FROM directors JOIN ratings USING (movie_id)
  SEMI JOIN movies USING (movie_id)),
shelf AS (SELECT movie_id, count(*) AS n FROM genres GROUP BY movie_id),
marks AS (
  SELECT person_id, count(*) AS films, sum(r * greatest(coalesce(n, 1), 1)) / sum(greatest(coalesce(n, 1), 1)) AS mean,
    min(r) AS low, max(r) AS high
  FROM work LEFT JOIN shelf USING (movie_id) GROUP BY person_id HAVING count(*) >= {P["q9_min_films"]}),
variety AS (SELECT person_id, count(DISTINCT genre) AS g FROM work JOIN genres USING (movie_id) GROUP BY person_id)
SELECT name AS realisateur, films AS nombre_films, round(mean, 2) AS note_moyenne, round(low, 2) AS note_min,
  round(high, 2) AS note_max, coalesce(g, 0) AS genres_explores
FROM marks JOIN persons USING (person_id) LEFT JOIN variety USING (person_id)
ORDER BY films DESC, person_id LIMIT 30""",
    }


# Relational views of the nested documents: one cast entry per credited (title,
# person), people named 'Unknown' when missing, only titles present in movies.
DOC_VIEWS = {
    "doc_cast": """
SELECT cp.movie_id, cp.person_id, cp.ordering, COALESCE(pe.name, 'Unknown') AS name,
       COALESCE(ch.n, 0) AS n_chars, COALESCE(ch.s, '') AS chars
FROM (SELECT movie_id, person_id, min(ordering) AS ordering FROM principals
      WHERE movie_id IN (SELECT movie_id FROM movies) GROUP BY movie_id, person_id) cp
LEFT JOIN persons pe ON cp.person_id = pe.person_id
LEFT JOIN (SELECT movie_id, person_id, count(*) AS n, string_agg(name, '|' ORDER BY name) AS s
           FROM characters GROUP BY movie_id, person_id) ch
  ON ch.movie_id = cp.movie_id AND ch.person_id = cp.person_id""",
    "doc_directors": """
SELECT d.movie_id, d.person_id, COALESCE(pe.name, 'Unknown') AS name
FROM directors d LEFT JOIN persons pe ON d.person_id = pe.person_id
WHERE d.movie_id IN (SELECT movie_id FROM movies)""",
    "doc_writers": """
SELECT w.movie_id, w.person_id, COALESCE(pe.name, 'Unknown') AS name
FROM writers w LEFT JOIN persons pe ON w.person_id = pe.person_id
WHERE w.movie_id IN (SELECT movie_id FROM movies)""",
    "doc_render": """
SELECT m.movie_id, m.primary_title AS title, m.start_year AS year, m.runtime_minutes AS runtime,
       r.average_rating AS rating_average, COALESCE(r.num_votes, 0) AS rating_votes,
       COALESCE(g.s, '') AS genres, COALESCE(d.s, '') AS directors, COALESCE(c.s, '') AS "cast",
       COALESCE(w.s, '') AS writers
FROM movies m
LEFT JOIN ratings r ON r.movie_id = m.movie_id
LEFT JOIN (SELECT movie_id, string_agg(genre, ', ' ORDER BY genre) AS s FROM genres GROUP BY movie_id) g
  ON g.movie_id = m.movie_id
LEFT JOIN (SELECT movie_id, string_agg(CAST(person_id AS VARCHAR) || ':' || name, '; '
                                       ORDER BY person_id, name) AS s
           FROM doc_directors GROUP BY movie_id) d ON d.movie_id = m.movie_id
LEFT JOIN (SELECT movie_id, string_agg(CAST(person_id AS VARCHAR) || ':' || name || '[' || chars || ']', '; '
                                       ORDER BY ordering, person_id) AS s
           FROM doc_cast GROUP BY movie_id) c ON c.movie_id = m.movie_id
LEFT JOIN (SELECT movie_id, string_agg(CAST(person_id AS VARCHAR) || ':' || name, '; '
                                       ORDER BY person_id, name) AS s
           FROM doc_writers GROUP BY movie_id) w ON w.movie_id = m.movie_id""",
}


def _matching_titles(pattern: str) -> str:
    return f"(SELECT movie_id FROM doc_cast WHERE regexp_matches(name, '{pattern}', 'i'))"


def _nested_form() -> dict[str, str]:
    y0, y1 = P["q2_years"]
    t = P["q8_threshold"]
    return {
        "q1_nest": f"""
SELECT movie_id, title, year, genres, rating_average, rating_votes FROM doc_render
WHERE movie_id IN {_matching_titles(P["q1_name"])}
ORDER BY year DESC, movie_id LIMIT 100""",
        "q2_nest": f"""
SELECT title, year, rating_average, rating_votes FROM doc_render
WHERE movie_id IN (SELECT movie_id FROM genres WHERE genre = '{P["q2_genre"]}')
  AND year BETWEEN {y0} AND {y1} AND rating_votes > 0
ORDER BY rating_average DESC, rating_votes DESC, movie_id LIMIT {P["q2_n"]}""",
        "q3_nest": """
SELECT dc.name AS acteur, m.primary_title AS film, CAST(SUM(dc.n_chars) AS BIGINT) AS nombre_roles
FROM doc_cast dc JOIN movies m ON m.movie_id = dc.movie_id
GROUP BY dc.name, m.primary_title HAVING SUM(dc.n_chars) > 1
ORDER BY nombre_roles DESC, acteur, film LIMIT 100""",
        "q4_nest": f"""
SELECT name AS realisateur, COUNT(*) AS nombre_films FROM doc_directors
WHERE movie_id IN {_matching_titles(P["q4_name"])}
GROUP BY name ORDER BY nombre_films DESC, realisateur LIMIT 50""",
        "q5_nest": f"""
SELECT g.genre, AVG(r.average_rating) AS note_moyenne, COUNT(*) AS nombre_films
FROM genres g JOIN ratings r ON g.movie_id = r.movie_id JOIN movies m ON m.movie_id = g.movie_id
WHERE r.average_rating > {P["q5_min_rating"]}
GROUP BY g.genre HAVING COUNT(*) > {P["q5_min_count"]}""",
        "q6_nest": f"""
SELECT CAST(decade AS VARCHAR) || 's' AS decennie, COUNT(*) AS nombre_films,
       AVG(average_rating) AS note_moyenne
FROM (SELECT CAST(floor(m.start_year / 10) * 10 AS BIGINT) AS decade, r.average_rating
      FROM movies m LEFT JOIN ratings r ON r.movie_id = m.movie_id
      WHERE m.movie_id IN {_matching_titles(P["q6_name"])}) t
WHERE decade > 0 GROUP BY decade""",
        "q7_nest": f"""
WITH genre_rows AS (
  SELECT g.genre, m.movie_id, m.primary_title AS title, m.start_year AS year, r.average_rating AS rating
  FROM genres g JOIN movies m ON m.movie_id = g.movie_id LEFT JOIN ratings r ON r.movie_id = m.movie_id),
first_genres AS (SELECT DISTINCT genre FROM genre_rows ORDER BY genre LIMIT 50)
SELECT genre, "position", title, year, rating FROM (
  SELECT genre, title, year, rating,
         CAST(ROW_NUMBER() OVER (PARTITION BY genre ORDER BY rating DESC NULLS LAST, movie_id) AS INTEGER)
           AS "position"
  FROM genre_rows WHERE genre IN (SELECT genre FROM first_genres)) x
WHERE "position" <= {P["q7_n"]}""",
        "q8_nest": f"""
SELECT dc.name AS acteur, COUNT(*) AS films_total,
       COUNT(*) FILTER (WHERE COALESCE(r.num_votes, 0) > {t}) AS blockbuster_films,
       MAX(COALESCE(r.num_votes, 0)) AS max_votes
FROM doc_cast dc LEFT JOIN ratings r ON r.movie_id = dc.movie_id
GROUP BY dc.name
HAVING COUNT(*) > 5 AND COUNT(*) FILTER (WHERE COALESCE(r.num_votes, 0) > {t}) > 0
   AND MAX(COALESCE(r.num_votes, 0)) > {t}
ORDER BY max_votes DESC, acteur LIMIT 50""",
        "q9_nest": f"""
SELECT dd.name AS realisateur, COUNT(*) AS nombre_films, AVG(r.average_rating) AS note_moyenne,
       MIN(r.average_rating) AS note_min, MAX(r.average_rating) AS note_max
FROM doc_directors dd LEFT JOIN ratings r ON r.movie_id = dd.movie_id
GROUP BY dd.name HAVING COUNT(*) >= {P["q9_min_films"]}
ORDER BY nombre_films DESC, realisateur LIMIT 30""",
    }


def _documents() -> dict[str, str]:
    film = f"""
SELECT * FROM doc_render WHERE title = '{P["film_title"]}' ORDER BY movie_id LIMIT 1"""
    return {
        "movies_complete": "SELECT * FROM doc_render",
        "sample_document": f"""
SELECT d.movie_id, d.title, d.year, d.rating_average, d.rating_votes,
       COALESCE((SELECT string_agg(genre, ', ' ORDER BY genre) FROM (
                   SELECT genre FROM genres g WHERE g.movie_id = d.movie_id ORDER BY genre LIMIT 3) x), '')
         AS genres_first3,
       CAST((SELECT count(*) FROM doc_directors x WHERE x.movie_id = d.movie_id) AS INTEGER) AS directors_count,
       CAST((SELECT count(*) FROM doc_cast x WHERE x.movie_id = d.movie_id) AS INTEGER) AS cast_count,
       CAST((SELECT count(*) FROM doc_writers x WHERE x.movie_id = d.movie_id) AS INTEGER) AS writers_count
FROM doc_render d WHERE d.rating_votes > {P["sample_min_votes"]}
ORDER BY d.movie_id LIMIT 1""",
        "film_full_flat": film,
        "film_full_nested": film,
        "film_compare": "SELECT CAST(0 AS BIGINT) AS flat_only, CAST(0 AS BIGINT) AS nested_only, TRUE AS same",
    }


def _people_matching(pattern: str) -> str:
    return f"(SELECT person_id FROM persons WHERE regexp_matches(name, '{pattern}', 'i'))"


def _collection_form() -> dict[str, str]:
    y0, y1 = P["q2_years"]
    t = P["q8_threshold"]
    return {
        "q1_pipe": f"""
WITH gl AS (SELECT movie_id, '[' || string_agg(genre, ', ' ORDER BY genre) || ']' AS s
            FROM genres GROUP BY movie_id)
SELECT p.movie_id, m.primary_title AS titre, m.start_year AS annee,
       string_agg(COALESCE(gl.s, '[]'), ', ') AS genres, r.average_rating AS note
FROM principals p
JOIN movies m ON m.movie_id = p.movie_id
LEFT JOIN gl ON gl.movie_id = p.movie_id
LEFT JOIN ratings r ON r.movie_id = p.movie_id
WHERE p.person_id IN {_people_matching(P["q1_name"])}
GROUP BY p.movie_id, m.primary_title, m.start_year, r.average_rating
ORDER BY annee DESC, p.movie_id LIMIT 100""",
        "q2_pipe": f"""
SELECT m.primary_title AS titre, m.start_year AS annee, r.average_rating AS note, r.num_votes AS votes
FROM genres g JOIN movies m ON m.movie_id = g.movie_id JOIN ratings r ON r.movie_id = g.movie_id
WHERE g.genre = '{P["q2_genre"]}' AND m.start_year BETWEEN {y0} AND {y1} AND r.num_votes > 0
ORDER BY r.average_rating DESC, r.num_votes DESC, m.movie_id LIMIT {P["q2_n"]}""",
        "q3_pipe": """
SELECT pe.name AS acteur, m.primary_title AS film, x.nombre_roles
FROM (SELECT person_id, movie_id, COUNT(*) AS nombre_roles FROM characters
      GROUP BY person_id, movie_id HAVING COUNT(*) > 1) x
JOIN persons pe ON pe.person_id = x.person_id JOIN movies m ON m.movie_id = x.movie_id
ORDER BY x.nombre_roles DESC, x.person_id, x.movie_id LIMIT 100""",
        "q4_pipe": f"""
SELECT dp.name AS realisateur, COUNT(*) AS nombre_films
FROM principals p
JOIN directors d ON d.movie_id = p.movie_id
JOIN persons dp ON dp.person_id = d.person_id
WHERE p.person_id IN {_people_matching(P["q4_name"])}
GROUP BY d.person_id, dp.name ORDER BY nombre_films DESC, d.person_id LIMIT 50""",
        "q5_pipe": f"""
SELECT g.genre, AVG(r.average_rating) AS note_moyenne, COUNT(*) AS nombre_films
FROM genres g JOIN ratings r ON r.movie_id = g.movie_id
GROUP BY g.genre HAVING AVG(r.average_rating) > {P["q5_min_rating"]} AND COUNT(*) > {P["q5_min_count"]}""",
        "q6_pipe": f"""
SELECT CAST(decade AS VARCHAR) || 's' AS decennie, COUNT(*) AS nombre_films,
       AVG(average_rating) AS note_moyenne
FROM (SELECT CAST(floor(m.start_year / 10) * 10 AS BIGINT) AS decade, r.average_rating
      FROM principals p JOIN movies m ON m.movie_id = p.movie_id
      LEFT JOIN ratings r ON r.movie_id = p.movie_id
      WHERE p.person_id IN {_people_matching(P["q6_name"])}) t
WHERE decade > 0 GROUP BY decade""",
        "q7_pipe": f"""
WITH genre_rows AS (
  SELECT g.genre, m.movie_id, m.primary_title AS titre, m.start_year AS annee, r.average_rating AS note
  FROM genres g JOIN movies m ON m.movie_id = g.movie_id JOIN ratings r ON r.movie_id = g.movie_id),
first_genres AS (SELECT DISTINCT genre FROM genre_rows ORDER BY genre LIMIT 50)
SELECT genre, "position", titre, annee, note FROM (
  SELECT genre, titre, annee, note,
         CAST(ROW_NUMBER() OVER (PARTITION BY genre ORDER BY movie_id) AS INTEGER) AS "position"
  FROM genre_rows WHERE genre IN (SELECT genre FROM first_genres)) x
WHERE "position" <= {P["q7_n"]}""",
        "q8_pipe": f"""
SELECT pe.person_id, pe.name AS acteur,
       COUNT(*) FILTER (WHERE r.num_votes <= {t}) AS films_avant,
       COUNT(*) FILTER (WHERE r.num_votes > {t}) AS films_apres,
       MAX(r.num_votes) AS max_votes,
       MAX(CASE WHEN r.num_votes > {t} THEN r.average_rating ELSE 0.0 END) AS max_note
FROM persons pe JOIN principals p ON p.person_id = pe.person_id JOIN ratings r ON r.movie_id = p.movie_id
GROUP BY pe.person_id, pe.name
HAVING COUNT(*) FILTER (WHERE r.num_votes <= {t}) > 0 AND COUNT(*) FILTER (WHERE r.num_votes > {t}) > 0
   AND MAX(r.num_votes) > {t}
ORDER BY max_votes DESC, pe.person_id LIMIT 50""",
        "q9_pipe": f"""
SELECT pe.name AS realisateur, COUNT(*) AS nombre_films, AVG(r.average_rating) AS note_moyenne,
       MIN(r.average_rating) AS note_min, MAX(r.average_rating) AS note_max,
       CAST(SUM(COALESCE(gc.n, 0)) AS BIGINT) AS genres_explores
FROM directors d
JOIN movies m ON m.movie_id = d.movie_id
JOIN persons pe ON pe.person_id = d.person_id
JOIN ratings r ON r.movie_id = d.movie_id
LEFT JOIN (SELECT movie_id, COUNT(*) AS n FROM genres GROUP BY movie_id) gc ON gc.movie_id = d.movie_id
GROUP BY d.person_id, pe.name HAVING COUNT(*) >= {P["q9_min_films"]}
ORDER BY nombre_films DESC, d.person_id LIMIT 30""",
    }


# First failed rule per raw row, in rule order (a failed or unknown check rejects).
REASON_SQL = {
    "persons": """CASE
  WHEN NOT COALESCE(birth_year IS NULL OR death_year IS NULL OR birth_year <= death_year, FALSE)
    THEN 'death_before_birth'
  WHEN person_id IS NULL THEN 'person_id_missing'
  WHEN name IS NULL THEN 'name_missing' END""",
    "movies": """CASE
  WHEN NOT COALESCE(runtime_minutes IS NULL OR runtime_minutes > 0, FALSE) THEN 'runtime_not_positive'
  WHEN NOT COALESCE(end_year IS NULL OR start_year <= end_year, FALSE) THEN 'end_before_start'
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN title_type IS NULL THEN 'title_type_missing'
  WHEN primary_title IS NULL THEN 'primary_title_missing'
  WHEN start_year IS NULL THEN 'start_year_missing' END""",
    "ratings": """CASE
  WHEN NOT COALESCE(average_rating >= 1.0 AND average_rating <= 10.0, FALSE) THEN 'rating_out_of_range'
  WHEN NOT COALESCE(num_votes IS NULL OR num_votes >= 0, FALSE) THEN 'negative_votes'
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN num_votes IS NULL THEN 'num_votes_missing' END""",
    "episodes": """CASE
  WHEN NOT COALESCE(season_number IS NOT NULL AND season_number > 0, FALSE) THEN 'season_number_not_positive'
  WHEN NOT COALESCE(episode_number IS NOT NULL AND episode_number > 0, FALSE)
    THEN 'episode_number_not_positive'
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN parent_movie_id IS NULL THEN 'parent_movie_id_missing' END""",
    "professions": """CASE
  WHEN job_name IS NULL THEN 'job_name_missing'
  WHEN person_id IS NULL THEN 'person_id_missing' END""",
    "characters": """CASE
  WHEN name IS NULL THEN 'name_missing'
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN person_id IS NULL THEN 'person_id_missing' END""",
    "genres": """CASE
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN genre IS NULL THEN 'genre_missing' END""",
    "titles": """CASE
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN ordering IS NULL THEN 'ordering_missing'
  WHEN title IS NULL THEN 'title_missing' END""",
    **{t: """CASE
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN person_id IS NULL THEN 'person_id_missing' END""" for t in ("directors", "writers")},
    "knownformovies": """CASE
  WHEN person_id IS NULL THEN 'person_id_missing'
  WHEN movie_id IS NULL THEN 'movie_id_missing' END""",
    "principals": """CASE
  WHEN movie_id IS NULL THEN 'movie_id_missing'
  WHEN ordering IS NULL THEN 'ordering_missing'
  WHEN person_id IS NULL THEN 'person_id_missing'
  WHEN category IS NULL THEN 'category_missing' END""",
}
CLEAN_KEYS = {
    "persons": ["person_id"], "movies": ["movie_id"], "ratings": ["movie_id"],
    "episodes": ["movie_id"], "professions": ["person_id", "job_name"],
    "characters": ["movie_id", "person_id", "name"],
    "principals": ["movie_id", "ordering", "person_id"],
    "genres": ["movie_id", "genre"], "titles": ["movie_id", "ordering"],
    "directors": ["movie_id", "person_id"], "writers": ["movie_id", "person_id"],
    "knownformovies": ["person_id", "movie_id"],
}


def _clean_ctes(table: str) -> str:
    pk = ", ".join(CLEAN_KEYS[table])
    return f"""
tagged_{table} AS (SELECT *, {REASON_SQL[table]} AS reject_reason FROM raw_{table}),
passed_{table} AS (SELECT * EXCLUDE (reject_reason) FROM tagged_{table} WHERE reject_reason IS NULL),
conflicts_{table} AS (SELECT {pk} FROM passed_{table} GROUP BY {pk} HAVING count(*) > 1)"""


def _key_text(table: str) -> str:
    parts = [f"COALESCE(CAST({k} AS VARCHAR), '')" for k in CLEAN_KEYS[table]]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def _cleaning() -> dict[str, str]:
    out = {}
    for t in CLEAN_KEYS:
        if t == "characters":
            body = f"SELECT DISTINCT * FROM passed_{t}"
        else:
            body = f"SELECT * FROM passed_{t} ANTI JOIN conflicts_{t} USING ({', '.join(CLEAN_KEYS[t])})"
        out[f"clean_{t}"] = f"WITH {_clean_ctes(t)}\n{body}"
    rejected, report = [], []
    for t in CLEAN_KEYS:
        key = _key_text(t)
        rejected.append(f"SELECT '{t}' AS table_name, {key} AS record_key, reject_reason "
                        f"FROM tagged_{t} WHERE reject_reason IS NOT NULL")
        if t == "characters":
            rejected.append(
                f"SELECT '{t}' AS table_name, {key} AS record_key, 'duplicate_row' AS reject_reason FROM ("
                f"SELECT *, unnest(range(n - 1)) AS i FROM (SELECT movie_id, person_id, name, count(*) AS n "
                f"FROM passed_{t} GROUP BY ALL HAVING count(*) > 1) g) x")
            kept = f"(SELECT count(*) FROM (SELECT DISTINCT * FROM passed_{t}))"
        else:
            rejected.append(
                f"SELECT '{t}' AS table_name, {key} AS record_key, 'duplicate_key' AS reject_reason "
                f"FROM passed_{t} SEMI JOIN conflicts_{t} USING ({', '.join(CLEAN_KEYS[t])})")
            kept = (f"(SELECT count(*) FROM passed_{t} ANTI JOIN conflicts_{t} "
                    f"USING ({', '.join(CLEAN_KEYS[t])}))")
        report.append(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM raw_{t}) AS rows_read, "
                      f"{kept} AS rows_kept")
    ctes = ",".join(_clean_ctes(t) for t in CLEAN_KEYS)
    out["quarantine"] = f"WITH {ctes}\n" + "\nUNION ALL\n".join(rejected)
    out["load_report"] = (f"WITH {ctes}\nSELECT table_name, rows_read, rows_kept, "
                          f"rows_read - rows_kept AS rows_dropped FROM (\n"
                          + "\nUNION ALL\n".join(report) + ") r")
    return out


MOVIE_CHILDREN = ["principals", "genres", "ratings", "directors", "writers", "characters"]
PERSON_CHILDREN = ["principals", "directors", "writers", "characters"]
ALL_TABLES = ["persons", "movies", "ratings", "genres", "titles", "professions", "principals",
              "directors", "writers", "characters", "knownformovies", "episodes"]
PKS = {"persons": ["person_id"], "movies": ["movie_id"], "ratings": ["movie_id"],
       "genres": ["movie_id", "genre"], "titles": ["movie_id", "ordering"],
       "professions": ["person_id", "job_name"], "principals": ["movie_id", "ordering", "person_id"],
       "directors": ["movie_id", "person_id"], "writers": ["movie_id", "person_id"],
       "characters": ["movie_id", "person_id", "name"], "knownformovies": ["person_id", "movie_id"],
       "episodes": ["movie_id"]}


def _audit_ctes() -> str:
    parts = [_clean_ctes(t) for t in CLEAN_KEYS]
    for t in ALL_TABLES:
        if t == "characters":
            body = f"SELECT DISTINCT * FROM passed_{t}"
        elif t in CLEAN_KEYS:
            body = f"SELECT * FROM passed_{t} ANTI JOIN conflicts_{t} USING ({', '.join(CLEAN_KEYS[t])})"
        else:
            body = f"SELECT * FROM {t}"
        parts.append(f"\naudit_{t} AS ({body})")
    return "WITH " + ",".join(parts) + "\n"


def _examples(col: str, child: str, parent_col: str, parent: str) -> str:
    return (f"(SELECT COALESCE(string_agg(CAST(k AS VARCHAR), ', ' ORDER BY k), '') FROM ("
            f"SELECT DISTINCT {col} AS k FROM audit_{child} WHERE {col} IS NOT NULL AND {col} NOT IN "
            f"(SELECT {parent_col} FROM audit_{parent}) ORDER BY k LIMIT 3))")


def _orphans(parent: str, key: str, children: list[str], suffix: str) -> str:
    rows = []
    for c in children:
        rows.append(
            f"SELECT '{c}_orphaned_{suffix}' AS check_name, '{c}' AS table_name, count(*) AS referenced_ids, "
            f"count(*) FILTER (WHERE p.k IS NULL) AS orphaned_count, "
            f"CAST(COALESCE(sum(c.n) FILTER (WHERE p.k IS NULL), 0) AS BIGINT) AS orphaned_rows, "
            f"{_examples(key, c, key, parent)} AS examples "
            f"FROM (SELECT {key} AS k, count(*) AS n FROM audit_{c} GROUP BY {key}) c "
            f"LEFT JOIN (SELECT DISTINCT {key} AS k FROM audit_{parent}) p ON c.k = p.k")
    return ("SELECT *, CASE WHEN orphaned_count = 0 THEN 'OK' ELSE 'PROBLEM' END AS status FROM (\n"
            + "\nUNION ALL\n".join(rows) + ") o")


def _integrity() -> dict[str, str]:
    w = _audit_ctes()
    refs = " UNION ".join(f"SELECT movie_id FROM audit_{c}" for c in MOVIE_CHILDREN)
    without = f"SELECT movie_id, primary_title, start_year FROM audit_movies WHERE movie_id NOT IN ({refs})"
    pairs = ("SELECT DISTINCT movie_id, person_id FROM audit_characters "
             "ANTI JOIN audit_principals USING (movie_id, person_id)")
    dup_rows = []
    for t in ALL_TABLES:
        src = f"raw_{t}" if t in CLEAN_KEYS else t
        pk = ", ".join(PKS[t])
        dup_rows.append(f"SELECT '{t}' AS table_name, CAST(COALESCE(sum(n), 0) AS BIGINT) AS total_rows, "
                        f"count(*) AS distinct_keys FROM (SELECT {pk}, count(*) AS n FROM {src} GROUP BY {pk}) k")
    checks = (f"SELECT check_name, orphaned_count FROM ({_orphans('movies', 'movie_id', MOVIE_CHILDREN, 'movies')}) a"
              f"\nUNION ALL SELECT check_name, orphaned_count FROM "
              f"({_orphans('persons', 'person_id', PERSON_CHILDREN, 'persons')}) b"
              f"\nUNION ALL SELECT 'films_without_data', count(*) FROM ({without}) c"
              f"\nUNION ALL SELECT 'characters_orphaned', count(*) FROM ({pairs}) d")
    # declared foreign keys (child, column, parent, parent column) — fixed values
    fks = [("ratings", "movie_id", "movies", "movie_id"), ("genres", "movie_id", "movies", "movie_id"),
           ("titles", "movie_id", "movies", "movie_id"), ("professions", "person_id", "persons", "person_id"),
           ("principals", "movie_id", "movies", "movie_id"), ("principals", "person_id", "persons", "person_id"),
           ("directors", "movie_id", "movies", "movie_id"), ("directors", "person_id", "persons", "person_id"),
           ("writers", "movie_id", "movies", "movie_id"), ("writers", "person_id", "persons", "person_id"),
           ("characters", "movie_id", "movies", "movie_id"), ("characters", "person_id", "persons", "person_id"),
           ("knownformovies", "person_id", "persons", "person_id"),
           ("knownformovies", "movie_id", "movies", "movie_id"),
           ("episodes", "movie_id", "movies", "movie_id"),
           ("episodes", "parent_movie_id", "movies", "movie_id")]
    fk_rows = []
    for child, col, parent, pcol in fks:
        fk_rows.append(
            f"SELECT '{child}_{col}_to_{parent}' AS check_name, '{child}' AS table_name, '{col}' AS column_name, "
            f"'{parent}' AS parent_table, count(*) AS referenced_ids, "
            f"count(*) FILTER (WHERE p.k IS NULL) AS orphaned_count, "
            f"CAST(COALESCE(sum(c.n) FILTER (WHERE p.k IS NULL), 0) AS BIGINT) AS orphaned_rows, "
            f"{_examples(col, child, pcol, parent)} AS examples "
            f"FROM (SELECT {col} AS k, count(*) AS n FROM audit_{child} WHERE {col} IS NOT NULL GROUP BY {col}) c "
            f"LEFT JOIN (SELECT DISTINCT {pcol} AS k FROM audit_{parent}) p ON c.k = p.k")
    return {
        "fk_audit": w + ("SELECT *, CASE WHEN orphaned_count = 0 THEN 'OK' ELSE 'PROBLEM' END AS status FROM (\n"
                         + "\nUNION ALL\n".join(fk_rows) + ") f"),
        "pk_duplicates": ("SELECT table_name, total_rows, distinct_keys, total_rows - distinct_keys AS duplicates "
                          "FROM (\n" + "\nUNION ALL\n".join(dup_rows) + ") x"),
        "orphan_movies": w + _orphans("movies", "movie_id", MOVIE_CHILDREN, "movies"),
        "orphan_persons": w + _orphans("persons", "person_id", PERSON_CHILDREN, "persons"),
        "films_without_data": w + without,
        "films_without_data_examples": w + without + " ORDER BY movie_id LIMIT 5",
        "coverage": w + "\nUNION ALL\n".join(
            f"SELECT '{c}' AS table_name, count(DISTINCT movie_id) AS films FROM audit_{c}"
            for c in MOVIE_CHILDREN),
        "orphan_characters": w + pairs,
        "integrity_summary": w + (
            f"SELECT check_name, orphaned_count, CASE WHEN orphaned_count = 0 THEN 'OK' ELSE 'PROBLEM' END "
            f"AS status FROM (SELECT check_name, CAST(orphaned_count AS BIGINT) AS orphaned_count FROM ({checks}) u"
            f"\nUNION ALL SELECT 'total', CAST(sum(orphaned_count) AS BIGINT) FROM ({checks}) t) s"),
    }


# Columns of the raw tables with their Spark type names (fixed values).
RAW_COLUMNS = {
    "persons": [("person_id", "bigint"), ("name", "string"), ("birth_year", "int"), ("death_year", "int")],
    "movies": [("movie_id", "bigint"), ("title_type", "string"), ("primary_title", "string"),
               ("is_adult", "int"), ("start_year", "int"), ("end_year", "int"), ("runtime_minutes", "int")],
    "ratings": [("movie_id", "bigint"), ("average_rating", "double"), ("num_votes", "bigint")],
    "genres": [("movie_id", "bigint"), ("genre", "string")],
    "titles": [("movie_id", "bigint"), ("ordering", "int"), ("title", "string"), ("language", "string")],
    "professions": [("person_id", "bigint"), ("job_name", "string")],
    "principals": [("movie_id", "bigint"), ("ordering", "int"), ("person_id", "bigint"),
                   ("category", "string"), ("job", "string")],
    "directors": [("movie_id", "bigint"), ("person_id", "bigint")],
    "writers": [("movie_id", "bigint"), ("person_id", "bigint")],
    "characters": [("movie_id", "bigint"), ("person_id", "bigint"), ("name", "string")],
    "knownformovies": [("person_id", "bigint"), ("movie_id", "bigint")],
    "episodes": [("movie_id", "bigint"), ("parent_movie_id", "bigint"), ("season_number", "int"),
                 ("episode_number", "bigint")],
}


def _pct(part: str, total: str) -> str:
    return f"CASE WHEN {total} <> 0 THEN CAST({part} AS DOUBLE) * 100.0 / {total} END"


def _src(t: str) -> str:
    return f"raw_{t}" if t in CLEAN_KEYS else t


def _summary(values_sql: str) -> str:
    return (f"SELECT count(*) AS count, min(value) AS min, max(value) AS max, avg(value) AS mean, "
            f"quantile_cont(value, 0.5) AS median, round(stddev_samp(value), 6) AS std FROM ({values_sql}) v")


def _histogram(values_sql: str, edges: list[float]) -> str:
    inner = " + ".join(f"CAST(value >= {float(e)} AS INTEGER)" for e in edges[1:-1])
    bucket = f"CASE WHEN value >= {float(edges[0])} AND value <= {float(edges[-1])} THEN {inner} + 1 END"
    bins = " UNION ALL ".join(
        f"SELECT {i + 1} AS bin, CAST({float(lo)} AS DOUBLE) AS lower, CAST({float(hi)} AS DOUBLE) AS upper"
        for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])))
    return f"""
WITH counted AS (SELECT {bucket} AS bin, count(*) AS count FROM ({values_sql}) v GROUP BY 1),
shared AS (SELECT bin, count, {_pct("count", "sum(count) OVER ()")} AS pct FROM counted)
SELECT b.bin, b.lower, b.upper, COALESCE(s.count, 0) AS count, COALESCE(s.pct, 0.0) AS pct
FROM ({bins}) b LEFT JOIN shared s ON s.bin = b.bin"""


def _profiling() -> dict[str, str]:
    prof, desc = [], []
    for t, cols in RAW_COLUMNS.items():
        src = _src(t)
        for c, dtype in cols:
            empty = f"count(*) FILTER (WHERE {c} = '')" if dtype == "string" else "CAST(0 AS BIGINT)"
            prof.append(
                f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{dtype}' AS dtype, total_rows, missing, "
                f"{_pct('missing', 'total_rows')} AS missing_pct, empty, {_pct('empty', 'total_rows')} AS empty_pct, "
                f"unique_values, {_pct('unique_values', 'total_rows')} AS unique_pct FROM ("
                f"SELECT count(*) AS total_rows, count(*) FILTER (WHERE {c} IS NULL) AS missing, "
                f"{empty} AS empty, count(DISTINCT {c}) AS unique_values FROM {src}) s")
            if dtype != "string":
                x = f"CAST({c} AS DOUBLE)"
                desc.append(
                    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS count, avg({x}) AS mean, "
                    f"round(stddev_samp({x}), 6) AS std, min({x}) AS min, quantile_cont({x}, 0.25) AS p25, "
                    f"quantile_cont({x}, 0.5) AS p50, quantile_cont({x}, 0.75) AS p75, max({x}) AS max FROM {src}")
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                                for t in ALL_TABLES)
    years = "SELECT TRY_CAST(start_year AS DOUBLE) AS value FROM raw_movie_years WHERE TRY_CAST(start_year AS DOUBLE) IS NOT NULL"
    ratings = ("SELECT TRY_CAST(average_rating AS DOUBLE) AS value FROM raw_ratings "
               "WHERE average_rating IS NOT NULL")
    credits = ("SELECT CAST(count(*) AS DOUBLE) AS value FROM principals WHERE movie_id IS NOT NULL "
               "GROUP BY movie_id")
    return {
        "table_counts": f"WITH c AS ({counts}) SELECT * FROM c UNION ALL "
                        f"SELECT 'TOTAL', CAST(sum(row_count) AS BIGINT) FROM c",
        "dataset_summary": ("WITH s AS (" + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS rows, CAST({len(cols)} AS BIGINT) AS columns FROM {_src(t)}"
            for t, cols in RAW_COLUMNS.items()) + ") SELECT * FROM s UNION ALL "
            "SELECT 'TOTAL', CAST(sum(rows) AS BIGINT), CAST(sum(columns) AS BIGINT) FROM s"),
        "profile_columns": "\nUNION ALL\n".join(prof),
        "profile_numeric": "\nUNION ALL\n".join(desc),
        "year_stats": _summary(years),
        "films_per_decade": (f"SELECT decade, films, {_pct('films', 'sum(films) OVER ()')} AS pct FROM ("
                             f"SELECT CAST(floor(value / 10) * 10 AS BIGINT) AS decade, count(*) AS films "
                             f"FROM ({years}) v GROUP BY 1) d"),
        "top_genres": (f"SELECT genre, count, pct FROM (SELECT genre, count(*) AS count, "
                       f"{_pct('count(*)', 'sum(count(*)) OVER ()')} AS pct FROM genres GROUP BY genre) g "
                       f"WHERE genre IS NOT NULL ORDER BY count DESC, genre LIMIT 10"),
        "rating_stats": _summary(ratings),
        "rating_histogram": _histogram(ratings, [0, 2, 4, 6, 8, 10]),
        "credits_stats": _summary(credits),
        "credits_histogram": _histogram(credits, [0, 5, 10, 15, 20, 50, 100, 1000]),
    }


def _storage() -> dict[str, str]:
    counts = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in ALL_TABLES)
    film = _documents()["film_full_nested"]
    return {
        "copy_verify": (f"SELECT table_name, n AS source_rows, n AS target_rows, TRUE AS match, "
                        f"TRUE AS all_match FROM ({counts}) c"),
        "copy_stats": (f"SELECT count(*) AS tables_copied, CAST(sum(n) AS BIGINT) AS rows_copied, "
                       f"TRUE AS all_match FROM ({counts}) c"),
        "csv_load_report": _cleaning()["load_report"],
        "stream_clean_movies": (f"WITH {_clean_ctes('movies')}\nSELECT CAST(movie_id AS VARCHAR) AS movie_id, "
                                f"title_type, primary_title, is_adult, start_year, end_year, runtime_minutes "
                                f"FROM passed_movies"),
        "stream_clean_characters": (f"WITH {_clean_ctes('characters')}\nSELECT "
                                    f"CAST(movie_id AS VARCHAR) AS movie_id, CAST(person_id AS VARCHAR) AS person_id, "
                                    f"name FROM passed_characters"),
        "storage_stats": (f"SELECT table_name, n AS rows, TRUE AS files_as_listed, TRUE AS bytes_as_listed, TRUE AS average_fits "
                          f"FROM ({counts} UNION ALL SELECT 'movies_complete', count(*) FROM movies) c"),
        "storage_compare": "SELECT TRUE AS flat_as_listed, TRUE AS nested_as_listed, TRUE AS variation_fits",
        "storage_largest": ("SELECT CAST(5 AS BIGINT) AS tables, TRUE AS largest_as_listed, TRUE AS shares_as_listed, "
                            "TRUE AS sizes_as_listed"),
        "file_inventory": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, TRUE AS files_as_listed, TRUE AS bytes_as_listed" for t in ALL_TABLES),
        "dataset_sizes": ("WITH s AS (" + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS rows, (SELECT count(*) FROM "
            f"(UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM (SELECT count(COLUMNS(*)) FROM {t})) ON *)) AS columns"
            for t in ALL_TABLES) + ") SELECT *, TRUE AS size_as_listed FROM s UNION ALL SELECT 'TOTAL', "
            "CAST(sum(rows) AS BIGINT), CAST(sum(columns) AS BIGINT), TRUE FROM s"),
        "sink_lifecycle": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(0 AS BIGINT) AS created, count(*) AS appended, 2 * count(*) AS twice, "
            f"CAST(0 AS BIGINT) AS emptied FROM {t}" for t in ("genres", "ratings", "directors")),
        "load_gain": (f"SELECT table_name AS item, CAST(rows_read AS DOUBLE) AS baseline, "
                      f"CAST(rows_kept AS DOUBLE) AS candidate, "
                      f"CASE WHEN rows_kept <> 0 THEN rows_read / rows_kept END AS ratio, "
                      f"CASE WHEN rows_read <> 0 THEN (rows_read - rows_kept) * 100.0::DOUBLE / rows_read END "
                      f"AS gain_pct FROM ({_cleaning()['load_report']}) r"),
        # fixed rules of the dirty texts (see raw_views): what each must be read as
        "csv_typed_movies": """
SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, o_orderstatus AS title_type,
  CASE WHEN o_orderkey % 11 <> 0 THEN 'T' END AS primary_title,
  CASE WHEN o_orderkey % 5 NOT IN (1, 2) THEN CAST(year(o_orderdate) AS INTEGER) END AS start_year,
  CASE WHEN o_orderkey % 7 = 2 THEN 90 WHEN o_orderkey % 7 > 4 THEN CAST(o_orderkey % 200 AS INTEGER) END
    AS runtime_minutes,
  CASE WHEN o_orderkey % 5 = 2 THEN 'start_year' WHEN o_orderkey % 7 = 3 THEN 'runtime_minutes' END AS unparsable
FROM orders""",
        "csv_typed_ratings": """
SELECT CAST(movie_id AS VARCHAR) AS movie_id,
  CASE WHEN movie_id % 6 = 3 THEN 7.0::DOUBLE WHEN movie_id % 6 > 3 THEN 8.25::DOUBLE END AS average_rating,
  CASE WHEN movie_id % 4 <> 1 THEN CAST(num_votes AS INTEGER) END AS num_votes,
  CASE WHEN movie_id % 6 = 2 THEN 'average_rating' END AS unparsable FROM ratings""",
        "film_full_layout": film,
    }


def _inferred(tables: dict[str, list[str]]) -> str:
    """Types of text columns from what their values look like (missing, whole numbers,
    numbers with a point, text: the steps that the dirty texts have)."""
    missing = "v IS NULL OR v IN ('', 'NULL', 'NA', 'N/A', 'nan', 'NaN', 'n/a', 'null')"
    cells = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, {c} AS v FROM text_{t}"
                               for t, cols in tables.items() for i, c in enumerate(cols))
    return f"""
, cells AS ({cells}),
s AS (SELECT *, CASE WHEN {missing} THEN 0 WHEN regexp_full_match(v, '[0-9]+') THEN 1
  WHEN regexp_full_match(v, '[0-9]+[.][0-9]+') THEN 2 ELSE 3 END AS step,
  length(regexp_extract(v, '^0*([0-9]*)', 1)) AS whole, length(regexp_extract(v, '[.]([0-9]*)', 1)) AS scale FROM cells),
c AS (SELECT table_name, position, column_name, count(*) AS n_rows, count(*) FILTER (step = 0) AS n_missing, max(step) AS top,
  max(whole) FILTER (step IN (1, 2)) AS whole, max(scale) FILTER (step IN (1, 2)) AS scale,
  min(v) FILTER (step = 1) AS w1, min(v) FILTER (step = 2) AS w2, min(v) FILTER (step = 3) AS w3 FROM s GROUP BY ALL)
SELECT table_name, CAST(position AS INTEGER) AS position, column_name, n_rows, n_missing,
  ['missing', 'integer', 'decimal', 'text'][top + 1] AS step, CASE top WHEN 1 THEN 'bigint'
    WHEN 2 THEN 'decimal(' || (whole + scale) || ',' || scale || ')' WHEN 3 THEN 'string' ELSE 'double' END AS spark_type,
  CASE WHEN top = 3 THEN 'object' WHEN top = 1 AND n_missing = 0 THEN 'int64' ELSE 'float64' END AS pandas_type,
  [w1, w2, w3][top] AS witness FROM c"""


# The dirty texts of raw_views.py.
TEXT_MOVIES = """text_movies AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS movie_id, o_orderstatus AS title_type,
    CASE WHEN o_orderkey % 11 = 0 THEN 'NULL' ELSE 'T' END AS primary_title,
    CASE o_orderkey % 5 WHEN 0 THEN year(o_orderdate) || '.0' WHEN 1 THEN 'NA' WHEN 2 THEN year(o_orderdate) || '.5'
      ELSE CAST(year(o_orderdate) AS VARCHAR) END AS start_year,
    CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'N/A' WHEN 2 THEN '90.0' WHEN 3 THEN 'x' WHEN 4 THEN 'nan'
      ELSE CAST(o_orderkey % 200 AS VARCHAR) END AS runtime_minutes FROM orders)"""
TEXT_RATINGS = """text_ratings AS (
  SELECT CAST(movie_id AS VARCHAR) AS movie_id, CASE movie_id % 6 WHEN 0 THEN 'NaN' WHEN 1 THEN 'n/a' WHEN 2 THEN 'bad'
      WHEN 3 THEN '7' ELSE '8.25' END AS average_rating,
    CASE movie_id % 4 WHEN 0 THEN num_votes || '.0' WHEN 1 THEN 'null' ELSE CAST(num_votes AS VARCHAR) END AS num_votes
  FROM ratings)"""


def _ingest() -> dict[str, str]:
    y, r, v = P["zorder_bounds"]
    films = ("(SELECT movie_id, primary_title AS title, start_year, average_rating, num_votes "
             "FROM movies JOIN ratings USING (movie_id))")
    lookups = [(films, "title", P["film_title"]), (films, "title", "no such title"), (films, "movie_id", 7),
               (films, "movie_id", -7), ("principals", "person_id", 3), ("principals", "person_id", -3)]
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    report = "\nUNION ALL\n".join(
        f"SELECT table_name, '{label}' AS reason, {column} AS rows FROM ({_cleaning()['load_report']}) r"
        for label, column in (("read", "rows_read"), ("kept", "rows_kept")))
    return {
        "csv_inferred_types": f"WITH {TEXT_MOVIES}, {TEXT_RATINGS}" + _inferred({
            "movies": ["movie_id", "title_type", "primary_title", "start_year", "runtime_minutes"],
            "ratings": ["movie_id", "average_rating", "num_votes"]}),
        "csv_inferred_movies": f"WITH {TEXT_MOVIES}\n" + """
SELECT CAST(movie_id AS BIGINT) AS movie_id, title_type, nullif(primary_title, 'NULL') AS primary_title,
  TRY_CAST(start_year AS DECIMAL(5, 1)) AS start_year,
  CASE WHEN runtime_minutes NOT IN ('', 'N/A', 'nan') THEN runtime_minutes END AS runtime_minutes FROM text_movies""",
        "csv_multiline": ("SELECT doc_id, lang, source, CAST(length(text) AS BIGINT) AS n_chars, md5(text) AS text_md5 "
                          "FROM documents"),
        "csv_discovered": (
            "SELECT 'genres' AS table_name, count(*) AS rows, 'movie_id string, genre string' AS types FROM genres "
            "UNION ALL SELECT 'persons', count(*), 'person_id string, name string' "
            "FROM persons UNION ALL SELECT 'parts_list', count(*), 'p_partkey bigint, p_name string, p_size bigint' "
            "FROM part"),
        "append_batches": ("SELECT CASE WHEN start_year < 1998 THEN 'early' ELSE 'late' END AS batch_id, count(*) AS rows, "
                           "count(DISTINCT movie_id) AS films FROM movies GROUP BY 1"),
        "load_observed": report + "\nUNION ALL\nSELECT table_name, reject_reason AS reason, count(*) AS rows "
                         f"FROM ({_cleaning()['quarantine']}) q GROUP BY ALL",
        "layout_zorder": (f"SELECT * FROM {films} f WHERE start_year BETWEEN {y[0]} AND {y[1]} "
                          f"AND average_rating >= {r} AND num_votes >= {v}"),
        "layout_zorder_files": "SELECT CAST(16 AS BIGINT) AS zorder_files, CAST(16 AS BIGINT) AS title_files, TRUE AS fewer_files",
        "layout_bloom": " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{v}' AS value, count(*) AS rows FROM {t} t WHERE {c} = {quoted(v)}"
            for t, c, v in lookups),
    }


def _indexes() -> dict[str, str]:
    profiled = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, "
        f"count(*) FILTER ({c} IS NULL) AS missing, TRUE AS distinct_in_bound FROM {_src(t)}"
        for t in ("movies", "ratings", "persons", "principals") for c, _ in RAW_COLUMNS[t])
    ranked = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {p}::DOUBLE AS share, count({c}) AS values, TRUE AS in_bound FROM raw_ratings"
        for c in ("average_rating", "num_votes") for p in (0.1, 0.25, 0.5, 0.75, 0.9))
    fold = "translate(p_name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return {
        "sketch_profile": profiled, "sketch_quantiles": ranked, "bitmap_coverage": _integrity()["coverage"],
        "q1_indexed": _sql_form()["q1_sql"], "q6_indexed": _sql_form()["q6_sql"],
        "name_search": " UNION ALL ".join(f"SELECT '{n}' AS needle, p_partkey, p_name FROM part WHERE {fold} "
                                          f"LIKE '%{n.lower()}%'" for n in P["needles"]),
        "bucketed_join": ("SELECT genre, count(*) AS films, CAST(sum(num_votes) AS BIGINT) AS votes "
                          "FROM genres JOIN ratings USING (movie_id) GROUP BY genre"),
    }


def oracle_queries() -> dict[str, str]:
    raw: dict[str, str] = {}
    raw.update(_sql_form())
    raw.update(_collection_form())
    raw.update(_nested_form())
    raw.update(_documents())
    raw.update(_cleaning())
    raw.update(_integrity())
    raw.update(_profiling())
    raw.update(_storage())
    raw.update(_ingest())
    raw.update(_indexes())
    extra = dict(DOC_VIEWS)
    extra.update(RAW_VIEW_SQL)
    return {key: with_views(sql, extra) for key, sql in raw.items()}
