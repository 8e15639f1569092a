"""The same results in plain SQL over the same tables."""

from __future__ import annotations

RATINGS = """
  numbered AS (
    SELECT CAST(l_partkey AS INTEGER) AS "MOVIE_ID",
           CAST(o_custkey AS INTEGER) AS "CUST_ID",
           (CAST(l_quantity AS INTEGER) - 1) % 5 + 1 AS "RATING",
           CAST(o_orderdate AS DATE) AS "DATE",
           CAST(l_linenumber AS INTEGER) AS line
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  ),
  ratings AS (SELECT "MOVIE_ID", "CUST_ID", "RATING", "DATE" FROM numbered),
  orig AS (SELECT * FROM ratings WHERE "DATE" < DATE '1999-01-01'),
  curr AS (SELECT * FROM ratings WHERE "DATE" >= DATE '1999-01-01')
"""

FACTORS = """
  factors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)
"""

FEEDBACK = """
  feedback AS (
    SELECT user_id AS query_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           value / 100 AS rating
    FROM events
  )
"""

PREDICTED = """
  means AS (SELECT "MOVIE_ID" AS m, avg("RATING") AS prediction FROM orig GROUP BY 1),
  orig_predicted AS (SELECT * FROM orig LEFT JOIN means ON "MOVIE_ID" = m),
  curr_predicted AS (SELECT * FROM curr LEFT JOIN means ON "MOVIE_ID" = m)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def in_train(ratio: str = "0.8") -> str:
    text = """concat_ws('|', '0', CAST("MOVIE_ID" AS VARCHAR), CAST("CUST_ID" AS VARCHAR), CAST("DATE" AS VARCHAR))"""
    return f"CAST('0x' || substr(md5({text}), 1, 7) AS BIGINT) / 268435456.0 < {ratio}"


SIDE = f"CASE WHEN {in_train()} THEN 'train' ELSE 'test' END"

COUNTS = ", ".join(
    f'count(*) FILTER (WHERE "RATING" = {v}) AS n{v}' for v in range(1, 6)
)


def kl(p: list[str], q: list[str]) -> str:
    """Divergence of two lists of count expressions."""

    def share(x: str, all_: list[str]) -> str:
        return f"(CAST({x} AS DOUBLE) / (CAST({' + '.join(all_)} AS DOUBLE) + 1e-10) + 1e-10)"

    return " + ".join(
        f"{share(a, p)} * ln({share(a, p)} / {share(b, q)})" for a, b in zip(p, q)
    )


def numbered(prefix: str) -> list[str]:
    return [f"{prefix}{v}" for v in range(1, 6)]


def summary(source: str, value: str, binned: str, prefix: str, infix: str, quantile: str = "quantile_disc") -> str:
    counts = ", ".join(
        f"count(*) FILTER (WHERE {binned} = {v}) AS {prefix}_n{v}" for v in range(1, 6)
    )
    return f"""
      SELECT {counts}, round(avg({value}), 6) AS {prefix}_{infix}mean,
             round(CAST({quantile}({value}, 0.5) AS DOUBLE), 6) AS {prefix}_{infix}median,
             count(*) AS {prefix}_total
      FROM {source}
    """


BIN = "CAST(least(greatest(round({}), 1), 5) AS INTEGER)"

DATA_REPORT = f"""
  data_report AS (
    SELECT *, {kl(numbered('original_n'), numbered('current_n'))} AS kl
    FROM ({summary('orig', '"RATING"', '"RATING"', 'original', '')}),
         ({summary('curr', '"RATING"', '"RATING"', 'current', '')})
  )
"""

MODEL_REPORT = f"""
  model_report AS (
    SELECT *, {kl(numbered('original_n'), numbered('current_n'))} AS kl
    FROM ({summary('(SELECT * FROM orig_predicted WHERE prediction IS NOT NULL)', 'prediction', BIN.format('prediction'), 'original', 'pred_', 'quantile_cont')}),
         ({summary('(SELECT * FROM curr_predicted WHERE prediction IS NOT NULL)', 'prediction', BIN.format('prediction'), 'current', 'pred_', 'quantile_cont')})
  )
"""

RANKED = """
  scored AS ({scored}),
  ranked AS (
    SELECT query_id, item_id, score, k,
           row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS r
    FROM scored
  )
  SELECT query_id, item_id, round(CAST(score AS DOUBLE), 6) + 0.0 AS score, CAST(r AS INTEGER) AS rank
  FROM ranked WHERE r <= k
"""

SCORE = "CAST(list_inner_product(q.features, i.features) AS FLOAT)"

NATION_FAVOURITES = """
  counts AS (
    SELECT c_nationkey, "MOVIE_ID", count(*) AS score
    FROM orig JOIN customer ON "CUST_ID" = c_custkey GROUP BY 1, 2
  ),
  best AS (
    SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY score DESC, "MOVIE_ID") AS r
    FROM counts
  ),
  recommended AS (
    SELECT CAST(c_custkey AS INTEGER) AS "CUST_ID", "MOVIE_ID", score
    FROM customer JOIN best USING (c_nationkey) WHERE r <= {k}
  ),
  places AS (
    SELECT "CUST_ID", "MOVIE_ID",
           row_number() OVER (PARTITION BY "CUST_ID" ORDER BY score DESC, "MOVIE_ID") AS place
    FROM recommended
  ),
  relevant AS (SELECT "CUST_ID", "MOVIE_ID", count(*) AS n FROM curr WHERE "RATING" >= 4 GROUP BY 1, 2),
  relevant_users AS (SELECT "CUST_ID", CAST(sum(n) AS BIGINT) AS n_relevant FROM relevant GROUP BY 1),
  found AS (
    SELECT p."CUST_ID", count(*) AS n_recommended, count(n) AS hits,
           sum(CASE WHEN n IS NULL THEN 0.0 ELSE ln(2.0) / ln(place + 1.0) END) AS dcg
    FROM places p LEFT JOIN relevant r ON p."CUST_ID" = r."CUST_ID" AND p."MOVIE_ID" = r."MOVIE_ID"
    GROUP BY 1
  ),
  per_user AS (
    SELECT "CUST_ID", hits, n_recommended, n_relevant,
           CAST(hits AS DOUBLE) / n_recommended AS "precision",
           CAST(hits AS DOUBLE) / n_relevant AS recall,
           dcg / (SELECT sum(ln(2.0) / ln(g + 1.0)) FROM range(1, {k} + 1) t(g)
                  WHERE g <= n_relevant) AS ndcg
    FROM found JOIN relevant_users USING ("CUST_ID")
  )
"""

UPSERT = f"""
  {with_(RATINGS)},
  both_parts AS (
    SELECT * FROM orig
    UNION ALL
    SELECT "MOVIE_ID", "CUST_ID", CASE WHEN line <> 7 THEN 6 - "RATING" END, "DATE"
    FROM numbered WHERE "DATE" >= DATE '1998-01-01'
  )
  SELECT "MOVIE_ID", "CUST_ID", "DATE", max("RATING") AS "RATING",
         CAST(year("DATE") AS INTEGER) AS year, CAST(month("DATE") AS INTEGER) AS month
  FROM both_parts WHERE "RATING" IS NOT NULL
  GROUP BY "MOVIE_ID", "CUST_ID", "DATE"
"""

MERGED_SIDES = f"""
  {with_(RATINGS)}
  SELECT "MOVIE_ID", "CUST_ID", "DATE", max("RATING") AS "RATING", {SIDE} AS side
  FROM ratings GROUP BY "MOVIE_ID", "CUST_ID", "DATE"
"""

#: Held-out ratings of users and items that the training part knows.
KNOWN_TEST = f"""
  {with_(RATINGS)},
  sides AS (
    SELECT "MOVIE_ID", "CUST_ID", "DATE", {SIDE} AS side FROM ratings
    GROUP BY "MOVIE_ID", "CUST_ID", "DATE"
  ),
  train AS (SELECT * FROM sides WHERE side = 'train'),
  known AS (
    SELECT * FROM sides
    WHERE side = 'test' AND "CUST_ID" IN (SELECT "CUST_ID" FROM train)
      AND "MOVIE_ID" IN (SELECT "MOVIE_ID" FROM train)
  )
"""

ALS_RANKED = f"""
  {KNOWN_TEST}
  SELECT "CUST_ID", 10::BIGINT AS n, true AS in_order FROM sides
  WHERE side = 'test' AND "CUST_ID" IN (SELECT "CUST_ID" FROM train) GROUP BY "CUST_ID"
"""

EVENTS = """
  e AS (
    SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS n, CAST(event_id AS VARCHAR) AS job
    FROM events
  )
"""

BAD_JSON = "decode-error: message is no valid JSON job"
BAD_K = "decode-error: k must be 1 to 500"
NO_SUBJECT = "decode-error: Provide either user_id or feedback for fold-in jobs"

#: Folding in one rating r of item v gives v·r / (v·v + λ).
ANSWERS = f"""
  {with_(EVENTS, FACTORS)},
  valid AS (SELECT * FROM e WHERE event_type IN ('view', 'click', 'purchase')
            AND NOT (event_type = 'view' AND n = 0)),
  asked AS (
    SELECT job, event_type, n,
           CASE event_type WHEN 'view' THEN user_id WHEN 'purchase' THEN user_id * 4 ELSE n END AS id,
           CASE event_type WHEN 'view' THEN n ELSE 20 END AS k,
           value / 100 AS rating
    FROM valid
  ),
  vectors AS (
    SELECT job, event_type, n, k,
           CASE WHEN event_type = 'click'
                THEN list_transform(features, lambda x: CAST(
                       x * rating / (list_inner_product(features, features) + 0.1) AS FLOAT)::DOUBLE)
                ELSE features END AS features
    FROM asked JOIN factors USING (id)
  ),
  subjects AS (SELECT DISTINCT features FROM vectors),
  pairs AS (
    SELECT q.features, i.id AS item_id, {SCORE} AS score FROM subjects q, factors i
  ),
  ranked AS (
    SELECT job, event_type, k, item_id, score,
           row_number() OVER (PARTITION BY job ORDER BY score DESC, item_id) AS r
    FROM vectors JOIN pairs USING (features)
    WHERE NOT (event_type = 'purchase' AND item_id IN (n, n + 1))
  )
  SELECT job AS job_id, 'RUNNING' AS status, '' AS error, '' AS source,
         0 AS rank, CAST(-1 AS BIGINT) AS item_id, 0.0::DOUBLE AS score FROM valid
  UNION ALL
  SELECT job, 'DONE', '', CASE WHEN event_type = 'view' THEN '' ELSE event_type END,
         CAST(r AS INTEGER), item_id, round(CAST(score AS DOUBLE), 4) + 0.0
  FROM ranked WHERE r <= k
  UNION ALL
  SELECT job, 'FAILED', 'Unknown user_id ' || id, '', 0, -1, 0.0
  FROM asked WHERE event_type <> 'click' AND id NOT IN (SELECT id FROM factors)
  UNION ALL
  SELECT job, 'FAILED',
         CASE event_type WHEN 'view' THEN '{BAD_K}' WHEN 'signup' THEN '{NO_SUBJECT}' ELSE '{BAD_JSON}' END,
         '', 0, -1, 0.0
  FROM e WHERE job NOT IN (SELECT job FROM valid)
"""

STATUS = """
  log AS (
    SELECT CAST(user_id AS VARCHAR) AS job_id,
           CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING'
                           WHEN 'signup' THEN 'PENDING' ELSE 'DONE' END AS status,
           CASE WHEN event_type = 'error' THEN 'code ' || json_extract_string(props, '$.k') END AS error,
           CASE WHEN event_type = 'click' THEN json_extract_string(props, '$.k') END AS n,
           event_id, ts
    FROM events
  ),
  last AS (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY event_id DESC) AS r
    FROM log WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 HOUR
  )
"""

PREDICTED_PAIRS = f"""
  {with_(FACTORS)}
  SELECT l_orderkey, l_linenumber, l_suppkey AS user_id, l_partkey AS item_id,
         round(coalesce(list_inner_product(u.features, i.features), 0.0), 6) + 0.0 AS prediction
  FROM lineitem LEFT JOIN factors u ON u.id = l_suppkey LEFT JOIN factors i ON i.id = l_partkey
"""

ORACLE: dict[str, str] = {
    "ratings_view": f"{with_(RATINGS)} SELECT * FROM ratings",
    "blocked_text_roundtrip": f"{with_(RATINGS)} SELECT * FROM ratings",
    "blocked_text_malformed": f"""
      {with_(RATINGS)},
      parsed AS (
        SELECT CASE WHEN "MOVIE_ID" % 10 <> 0 THEN "MOVIE_ID" ELSE -1 END AS "MOVIE_ID",
               CASE WHEN line IN (3, 4, 5, 7) THEN -1 ELSE "CUST_ID" END AS "CUST_ID",
               CASE WHEN line IN (2, 3, 4, 5) THEN -1 ELSE "RATING" END AS "RATING",
               CASE WHEN line IN (3, 4, 5, 6, 7) THEN 'none' ELSE CAST("DATE" AS VARCHAR) END AS "DATE"
        FROM numbered
      )
      SELECT *, count(*) AS n FROM parsed GROUP BY ALL
    """,
    "csv_arrivals": f"""
      {with_(RATINGS)}
      SELECT "DATE", "CUST_ID", "MOVIE_ID", "RATING" FROM numbered WHERE line NOT IN (2, 3, 5)
    """,
    "partition_counts": f"""
      {with_(RATINGS)}
      SELECT CAST(year("DATE") AS INTEGER) AS year, CAST(month("DATE") AS INTEGER) AS month,
             count(*) AS n, CAST(sum("RATING") AS BIGINT) AS sum_rating
      FROM ratings GROUP BY 1, 2
    """,
    "upsert_merge": UPSERT,
    "upsert_rewrite_all": UPSERT,
    "merge_by_files": f"SELECT *, 3 AS n_commits, true AS some_replaced, true AS again_nothing FROM ({UPSERT})",
    "replay_order": f"""
      {with_(RATINGS)}
      SELECT "DATE", count(*) AS n, CAST(sum("RATING") AS BIGINT) AS sum_rating,
             CAST(0 AS BIGINT) AS n_misplaced
      FROM ratings GROUP BY 1
    """,
    "factor_manifest": """
      SELECT (SELECT count(*) FROM embeddings WHERE vec_id IN (SELECT c_custkey FROM customer)) AS user_count,
             count(*) AS item_count, CAST(max(len(embedding)) AS INTEGER) AS rank,
             'id' AS user_id_column, 'id' AS item_id_column, 'version_20050101_000000' AS source_version
      FROM embeddings
    """,
    "factor_checks": """
      SELECT count(*) AS n, count(*) - count(vec_id) AS null_ids, count(DISTINCT vec_id) AS distinct_ids,
             count(*) FILTER (WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0) AS bad_vectors,
             CAST(min(len(embedding)) AS INTEGER) AS min_rank, CAST(max(len(embedding)) AS INTEGER) AS max_rank
      FROM embeddings
    """,
    "registered_table": f"""
      {with_(RATINGS)}
      SELECT "MOVIE_ID", "CUST_ID", "DATE", max("RATING") AS "RATING",
             CAST(year("DATE") AS INTEGER) AS year, CAST(month("DATE") AS INTEGER) AS month
      FROM ratings GROUP BY "MOVIE_ID", "CUST_ID", "DATE"
    """,
    "dedupe_keep_max": f"""
      {with_(RATINGS)},
      ranked AS (
        SELECT *, row_number() OVER (
          PARTITION BY "MOVIE_ID", "CUST_ID", "DATE" ORDER BY "RATING" DESC) AS r
        FROM ratings
      )
      SELECT "MOVIE_ID", "CUST_ID", "RATING", "DATE" FROM ranked WHERE r = 1
    """,
    "dedupe_latest_of_best": f"""
      {with_(RATINGS)},
      ranked AS (
        SELECT *, row_number() OVER (
          PARTITION BY "MOVIE_ID", "CUST_ID" ORDER BY "RATING" DESC, "DATE" DESC, line DESC) AS r
        FROM numbered
      )
      SELECT "MOVIE_ID", "CUST_ID", "RATING", "DATE", line FROM ranked WHERE r = 1
    """,
    "split_by_key": f"{with_(RATINGS)} SELECT *, {SIDE} AS side FROM ratings",
    "rating_histogram": f"""
      {with_(RATINGS)}
      SELECT CAST(year("DATE") AS INTEGER) AS year, {COUNTS} FROM ratings GROUP BY 1
    """,
    "rating_location": f"""
      {with_(RATINGS)}
      SELECT round(avg("RATING"), 6) AS mean, CAST(quantile_cont("RATING", 0.5) AS DOUBLE) AS median,
             count(*) AS total
      FROM ratings
    """,
    "kl_by_year": f"""
      {with_(RATINGS)},
      yearly AS (SELECT CAST(year("DATE") AS INTEGER) AS year, {COUNTS} FROM ratings GROUP BY 1),
      overall AS (SELECT {', '.join(f'CAST(sum(n{v}) AS BIGINT) AS a{v}' for v in range(1, 6))} FROM yearly)
      SELECT year, round({kl(numbered('a'), numbered('n'))}, 9) AS kl_divergence FROM yearly, overall
    """,
    "data_drift": f"""
      {with_(RATINGS, DATA_REPORT)}
      SELECT * EXCLUDE (kl), round(kl, 9) AS kl_divergence FROM data_report
    """,
    "summary_drift": f"""
      {with_(RATINGS)},
      changed AS (
        SELECT "MOVIE_ID", "CUST_ID", "DATE", max("RATING") AS "RATING" FROM (
          SELECT "MOVIE_ID", "CUST_ID", "DATE", "RATING" FROM orig
          UNION ALL
          SELECT "MOVIE_ID", "CUST_ID", "DATE", CASE WHEN line <> 7 THEN 6 - "RATING" END
          FROM numbered WHERE year("DATE") = 1998
        ) WHERE "RATING" IS NOT NULL GROUP BY 1, 2, 3
      ),
      report AS (
        SELECT *, {kl(numbered('original_n'), numbered('current_n'))} AS kl
        FROM ({summary('changed', '"RATING"', '"RATING"', 'original', '')}),
             ({summary('curr', '"RATING"', '"RATING"', 'current', '')})
      )
      SELECT * EXCLUDE (kl, original_median, current_median), round(kl, 9) AS kl_divergence,
             true AS original_median_fits, true AS current_median_fits
      FROM report
    """,
    "bin_predictions": f"""
      SELECT {BIN.format('value / 100')} AS bin, count(*) AS n FROM events GROUP BY 1
    """,
    "prediction_drift": f"""
      {with_(RATINGS, PREDICTED, MODEL_REPORT)}
      SELECT * EXCLUDE (kl), round(kl, 9) AS kl_divergence
      FROM model_report
    """,
    "retrain_decision": f"""
      {with_(RATINGS, PREDICTED, DATA_REPORT, MODEL_REPORT)},
      measures AS (
        SELECT d.kl AS dkl, m.kl AS mkl,
               abs((SELECT avg("RATING") FROM curr) - (SELECT avg("RATING") FROM orig)) AS dmean,
               abs((SELECT avg(prediction) FROM curr_predicted)
                   - (SELECT avg(prediction) FROM orig_predicted)) AS mmean,
               abs(d.current_median - d.original_median) AS dmed,
               abs((SELECT quantile_cont(prediction, 0.5) FROM curr_predicted)
                   - (SELECT quantile_cont(prediction, 0.5) FROM orig_predicted)) AS mmed
        FROM data_report d, model_report m
      ),
      scores AS (
        SELECT *, 0.5 * dkl / 1e-6 + 0.4 * dmean / 1e-4 + 0.1 * dmed / 1e-4 AS ds,
               0.5 * mkl / 1e-6 + 0.4 * mmean / 1e-4 + 0.1 * mmed / 1e-4 AS ms,
               [CASE WHEN dkl > 1e-6 THEN printf('Data KL divergence (%.4f) exceeds threshold (1e-06)', dkl) END,
                CASE WHEN dmean > 1e-4 THEN printf('Data mean shift (%.4f) exceeds threshold (0.0001)', dmean) END,
                CASE WHEN dmed > 1e-4 THEN printf('Data median shift (%.1f) exceeds threshold (0.0001)', dmed) END,
                CASE WHEN mkl > 1e-6 THEN printf('Model KL divergence (%.4f) exceeds threshold (1e-06)', mkl) END,
                CASE WHEN mmean > 1e-4 THEN printf('Model mean shift (%.4f) exceeds threshold (0.0001)', mmean) END,
                CASE WHEN mmed > 1e-4 THEN printf('Model median shift (%.4f) exceeds threshold (0.0001)', mmed) END
               ] AS all_reasons
        FROM measures
      ),
      reasoned AS (SELECT *, list_filter(all_reasons, lambda x: x IS NOT NULL) AS kept FROM scores)
      SELECT greatest(ds, ms) > 1.0 AS should_retrain, round(greatest(ds, ms), 4) AS drift_score,
             round(ds, 4) AS data_drift_score, round(ms, 4) AS model_drift_score,
             CAST(len(kept) AS BIGINT) AS n_reasons, array_to_string(kept, '; ') AS reasons,
             0.0001::DOUBLE AS mean_threshold, 0.5::DOUBLE AS kl_weight
      FROM reasoned
    """,
    "predict_pairs": PREDICTED_PAIRS,
    "predict_pairs_bucketed": PREDICTED_PAIRS,
    "predict_lists": f"""
      {with_(FACTORS)}
      SELECT l_orderkey AS query_id,
             round(coalesce(list_inner_product(u.features, i.features), 0.0), 6) + 0.0 AS rating
      FROM lineitem LEFT JOIN factors u ON u.id = l_suppkey LEFT JOIN factors i ON i.id = l_partkey
    """,
    "topk_inner_product": with_(FACTORS)
    + ","
    + RANKED.format(
        scored=f"SELECT q.id AS query_id, i.id AS item_id, 10 AS k, {SCORE} AS score FROM factors q, factors i"
    ),
    "topk_with_exclusions": with_(FACTORS, FEEDBACK)
    + ","
    + RANKED.format(
        scored=f"""SELECT q.id AS query_id, i.id AS item_id, 10 AS k, {SCORE} AS score
                   FROM factors q, factors i
                   WHERE NOT EXISTS (SELECT 1 FROM feedback f WHERE f.query_id = q.id AND f.item_id = i.id)"""
    ),
    "topk_norm_index": "SELECT *, true AS half_skipped FROM ("
    + with_(FACTORS, FEEDBACK)
    + """,
      scaled AS (
        SELECT id, [CAST(CAST(x * pow(2.0, -CAST(id % 97 AS DOUBLE) / 8) AS FLOAT) AS DOUBLE) FOR x IN features] AS features
        FROM factors
      ),"""
    + RANKED.format(
        scored=f"""SELECT q.id AS query_id, i.id AS item_id, 10 AS k, {SCORE} AS score
                   FROM factors q, scaled i
                   WHERE NOT EXISTS (SELECT 1 FROM feedback f WHERE f.query_id = q.id AND f.item_id = i.id)"""
    )
    + ")",
    "recommend_known_users": with_(FACTORS)
    + ","
    + RANKED.format(
        scored=f"""SELECT q.id AS query_id, i.id AS item_id, {SCORE} AS score,
                          CASE WHEN c_nationkey = 0 THEN 20 ELSE c_nationkey END AS k
                   FROM customer JOIN factors q ON q.id = c_custkey, factors i"""
    ),
    "exclude_scored": f"""
      {with_(RATINGS, FEEDBACK)}
      SELECT CAST("CUST_ID" AS BIGINT) AS query_id, CAST("MOVIE_ID" AS BIGINT) AS item_id, "RATING"
      FROM ratings
      WHERE NOT EXISTS (SELECT 1 FROM feedback f WHERE f.query_id = "CUST_ID" AND f.item_id = "MOVIE_ID")
    """,
    "mean_item_vector": """
      SELECT CAST(pos - 1 AS INTEGER) AS dim,
             round(CAST(CAST(avg(CAST(embedding[pos] AS DOUBLE)) AS FLOAT) AS DOUBLE), 6) + 0.0 AS value
      FROM embeddings, range(1, (SELECT max(len(embedding)) FROM embeddings) + 1) t(pos)
      GROUP BY 1
    """,
    "normal_equations": f"""
      {with_(FACTORS, FEEDBACK)},
      dims AS (SELECT pos, pos % 64 + 1 AS following FROM range(1, 65) t(pos))
      SELECT query_id, CAST(pos - 1 AS INTEGER) AS dim,
             round(sum(rating * features[pos]), 6) + 0.0 AS rhs,
             round(sum(features[pos] * features[pos]), 6) + 0.0 AS diagonal,
             round(sum(features[pos] * features[following]), 6) + 0.0 AS next
      FROM feedback JOIN factors ON item_id = id, dims
      GROUP BY query_id, pos
    """,
    "fold_in_residual": f"""
      {with_(FACTORS, FEEDBACK)}
      SELECT DISTINCT query_id, true AS solved, CAST(64 AS BIGINT) AS rank
      FROM feedback WHERE item_id IN (SELECT id FROM factors)
    """,
    "feedback_increments": f"""
      {with_(FACTORS, FEEDBACK)},
      used AS (
        SELECT query_id, features, sum(rating) AS total, count(*) AS n
        FROM feedback JOIN factors ON item_id = id GROUP BY query_id, id, features
      )
      SELECT query_id, CAST(i - 1 AS INTEGER) AS i, CAST(j - 1 AS INTEGER) AS j,
             round(sum(n * features[i] * features[j]), 6) + 0.0 AS value
      FROM used, range(1, 65) a(i), range(1, 65) b(j) WHERE i <= j GROUP BY query_id, i, j
      UNION ALL
      SELECT query_id, CAST(i - 1 AS INTEGER), 64, round(sum(total * features[i]), 6) + 0.0
      FROM used, range(1, 65) a(i) GROUP BY query_id, i
    """,
    "fold_in_kinds": f"""
      {with_(FACTORS, FEEDBACK)}
      SELECT DISTINCT query_id, implicit, nonnegative, true AS met, CAST(64 AS BIGINT) AS rank
      FROM feedback, (VALUES (true, false), (false, true), (true, true)) AS kinds(implicit, nonnegative)
      WHERE item_id IN (SELECT id FROM factors)
    """,
    "regression_metrics": f"""
      {with_(RATINGS, PREDICTED)}
      SELECT round(sqrt(avg(("RATING" - prediction) * ("RATING" - prediction))), 6) AS rmse,
             round(avg(abs("RATING" - prediction)), 6) AS mae, count(*) AS n
      FROM curr_predicted WHERE prediction IS NOT NULL
    """,
    "ranking_metrics": f"""
      {with_(RATINGS)}, {NATION_FAVOURITES.format(k=10)}
      SELECT round(avg("precision"), 6) AS "precision", round(avg(recall), 6) AS recall,
             round(avg(ndcg), 6) AS ndcg, count(*) AS n_users
      FROM per_user
    """,
    "ranking_per_user": f"""
      {with_(RATINGS)}, {NATION_FAVOURITES.format(k=5)}
      SELECT "CUST_ID", hits, n_recommended, n_relevant, round("precision", 6) AS "precision",
             round(recall, 6) AS recall, round(ndcg, 6) AS ndcg
      FROM per_user
    """,
    "nation_top_items": f"""
      {with_(RATINGS)},
      counts AS (
        SELECT c_nationkey, "MOVIE_ID", count(*) AS score
        FROM ratings JOIN customer ON "CUST_ID" = c_custkey GROUP BY 1, 2
      ),
      places AS (
        SELECT *, CAST(row_number() OVER (
          PARTITION BY c_nationkey ORDER BY score DESC, "MOVIE_ID") AS INTEGER) AS rank
        FROM counts
      )
      SELECT * FROM places WHERE rank <= 10
    """,
    "als_coverage": f"{KNOWN_TEST} SELECT count(*) AS n_scored, 8 AS rank FROM known",
    "als_scores_agree": f"{KNOWN_TEST} SELECT count(*) AS n_scored, true AS agree FROM known",
    "als_topk_agree": f"""
      {KNOWN_TEST}
      SELECT 10 * count(DISTINCT "CUST_ID") AS n, true AS agree FROM sides
      WHERE side = 'test' AND "CUST_ID" IN (SELECT "CUST_ID" FROM train)
    """,
    "als_predict": f"""
      {KNOWN_TEST}
      SELECT "MOVIE_ID", "CUST_ID", "DATE", max(r."RATING") AS "RATING", true AS plausible
      FROM known JOIN ratings r USING ("MOVIE_ID", "CUST_ID", "DATE") GROUP BY 1, 2, 3
    """,
    "als_topk": ALS_RANKED,
    "als_topk_nested": ALS_RANKED,
    "als_evaluate": f"""
      {KNOWN_TEST}
      SELECT count(*) AS test_ratings_count, 8 AS model_rank, 10 AS k, 4.0::DOUBLE AS rating_threshold, true AS agree
      FROM sides WHERE side = 'test'
    """,
    "als_prediction_drift": f"""
      {KNOWN_TEST}
      SELECT count(*) FILTER (WHERE "DATE" < DATE '1999-01-01') AS original_total,
             count(*) FILTER (WHERE "DATE" >= DATE '1999-01-01') AS current_total,
             true AS all_binned, true AS divergence_made
      FROM known
    """,
    "fold_in_recommend": f"""
      {with_(FACTORS, FEEDBACK)}
      SELECT DISTINCT query_id, least(20, (SELECT count(*) FROM factors)) AS n,
             CAST(least(20, (SELECT count(*) FROM factors)) AS INTEGER) AS last, true AS agree
      FROM feedback
    """,
    "drift_cycle": f"""
      {KNOWN_TEST}
      SELECT true AS retrained, true AS over_one, count(*) AS test_ratings_count, 8 AS model_rank, true AS in_range
      FROM sides WHERE side = 'test'
    """,
    "resumed_cycle": f"""
      {KNOWN_TEST},
      steps AS (
        SELECT unnest(['stage', 'remove_source', 'current', 'decide', 'merge', 'remove_staged', 'version', 'train', 'evaluate']) AS step,
               unnest(range(9)) AS place
      )
      SELECT CAST(place AS INTEGER) AS place, step, 2 AS times_lost, true AS retrained, true AS over_one,
             (SELECT count(*) FROM sides WHERE side = 'test') AS test_ratings_count,
             (SELECT count(*) FROM sides WHERE side = 'train') AS n_train,
             (SELECT count(*) FROM sides WHERE side = 'test') AS n_test,
             2 AS n_versions, true AS same_report
      FROM steps
    """,
    "drift_two_cycles": f"""
      {KNOWN_TEST},
      steps AS (
        SELECT *, CASE WHEN "DATE" < DATE '1999-01-01' THEN 0 WHEN year("DATE") = 1999 THEN 1 ELSE 2 END AS step FROM sides
      )
      SELECT s AS step,
             count(*) FILTER (WHERE step < s AND side = 'train') AS original_total,
             count(*) FILTER (WHERE step = s AND side = 'train') AS current_total,
             count(*) FILTER (WHERE step <= s AND side = 'train') AS n_train,
             count(*) FILTER (WHERE step <= s AND side = 'test') AS n_test,
             true AS merged, true AS removed
      FROM steps, (VALUES (1), (2)) AS v(s) GROUP BY s
    """,
    "als_manifest": f"""
      {with_(RATINGS)}
      SELECT count(DISTINCT "CUST_ID") AS user_count, count(DISTINCT "MOVIE_ID") AS item_count,
             8 AS rank, 'id' AS user_id_column, 'id' AS item_id_column,
             'version_20050101_000000' AS source_version, true AS complete
      FROM ratings
    """,
    "resolve_complete": """
      SELECT count(*) AS user_count, count(*) AS item_count, 64 AS rank, 'id' AS user_id_column, 'id' AS item_id_column,
             'version_20050101_000000' AS source_version, 3 AS n_versions, 64 AS loaded_rank
      FROM embeddings
    """,
    "ingest_plan": f"""
      {with_(RATINGS)}
      SELECT "MOVIE_ID", "CUST_ID", "DATE", max("RATING") AS "RATING",
             CASE WHEN "DATE" < DATE '1999-01-01' THEN 'train' ELSE 'test' END AS side
      FROM ratings GROUP BY "MOVIE_ID", "CUST_ID", "DATE"
    """,
    "replay_plan": f"""
      {with_(RATINGS)} SELECT "DATE", "CUST_ID", "MOVIE_ID", "RATING" FROM ratings
    """,
    "plan_counts": f"""
      {with_(RATINGS)},
      first AS (SELECT *, {SIDE} AS side FROM orig),
      arrived AS (
        SELECT "MOVIE_ID", "CUST_ID", "DATE", CASE WHEN line <> 7 THEN 6 - "RATING" END AS "RATING"
        FROM numbered WHERE "DATE" >= DATE '1998-01-01'
      ),
      later AS (SELECT *, {SIDE} AS side FROM arrived WHERE "RATING" IS NOT NULL),
      stored AS (SELECT DISTINCT side, "MOVIE_ID", "CUST_ID", "DATE" FROM first),
      staged AS (SELECT DISTINCT side, "MOVIE_ID", "CUST_ID", "DATE" FROM later),
      touched AS (SELECT DISTINCT side, date_trunc('month', "DATE") AS month FROM staged),
      old AS (SELECT s.* FROM stored s JOIN touched t ON s.side = t.side AND date_trunc('month', s."DATE") = t.month),
      sizes AS (
        SELECT 'ingest' AS step, side, count(*) AS rows_in, 0 AS existing,
               (SELECT count(*) FROM stored s WHERE s.side = f.side) AS written
        FROM first f GROUP BY side
        UNION ALL
        SELECT 'stage', side, count(*), 0, (SELECT count(*) FROM staged s WHERE s.side = l.side) FROM later l GROUP BY side
        UNION ALL
        SELECT 'merge', side, count(*), (SELECT count(*) FROM old o WHERE o.side = s.side),
               (SELECT count(*) FROM (SELECT * FROM old UNION SELECT * FROM staged) u WHERE u.side = s.side)
        FROM staged s GROUP BY side
      )
      SELECT step, side, rows_in, CAST(0 AS BIGINT) AS incomplete, CAST(existing AS BIGINT) AS existing, written,
             CAST(written - existing AS BIGINT) AS added FROM sizes
      UNION ALL
      SELECT 'arrive', '', count(*), count(*) - count("RATING"), 0, count("RATING"), 0 FROM arrived
    """,
    "merge_staged": MERGED_SIDES,
    "stage_stream": MERGED_SIDES,
    "drift_cycle_data": MERGED_SIDES,
    "validate_requests": f"""
      {with_(EVENTS)}
      SELECT job AS job_id,
             CASE WHEN event_type = 'error' THEN '{BAD_JSON}'
                  WHEN event_type = 'view' AND n = 0 THEN '{BAD_K}'
                  WHEN event_type = 'signup' THEN '{NO_SUBJECT}' ELSE '' END AS error,
             CASE WHEN event_type = 'view' AND n > 0 THEN n
                  WHEN event_type IN ('click', 'purchase') THEN 20 ELSE -1 END AS k,
             CASE WHEN event_type = 'click' THEN 1 WHEN event_type = 'purchase' THEN 0
                  WHEN event_type = 'view' AND n > 0 THEN 0 ELSE -1 END AS n_feedback,
             CASE WHEN event_type = 'purchase' THEN 2 WHEN event_type = 'click' THEN 0
                  WHEN event_type = 'view' AND n > 0 THEN 0 ELSE -1 END AS n_excluded
      FROM e
    """,
    "submit_jobs": f"""
      {with_(EVENTS)}
      SELECT user_id, n + 1 AS k, count(*) AS n, count(*) AS n_ids, count(*) AS n_events, count(*) AS n_pending
      FROM e GROUP BY 1, 2
    """,
    "answer_jobs": ANSWERS,
    "stream_jobs": ANSWERS,
    "result_messages": f"""
      {with_(STATUS)}
      SELECT job_id, status, count(*) AS n, count(error) AS n_errors
      FROM log WHERE NOT (status = 'FAILED' AND error LIKE '%7') GROUP BY 1, 2
    """,
    "latest_status": f"""
      {with_(STATUS)}
      SELECT job_id, status, coalesce(error, '') AS error, event_id FROM last WHERE r = 1
    """,
    "lookup_status": f"""
      {with_(STATUS)}
      SELECT CAST(c_custkey AS VARCHAR) AS job_id, coalesce(status, 'PENDING') AS status,
             coalesce(error, '') AS error, coalesce(n, '') AS n, true AS no_items
      FROM customer LEFT JOIN (SELECT * FROM last WHERE r = 1) l ON l.job_id = CAST(c_custkey AS VARCHAR)
    """,
    "status_table": f"""
      {with_(STATUS)},
      batched AS (
        SELECT *, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END * 3 + event_id % 3 AS batch FROM log
      )
      SELECT job_id, status, coalesce(error, '') AS error, event_id, CAST(batch AS BIGINT) AS batch,
             1 AS n_expired_hours, 2 AS n_hours, 1 AS n_runs
      FROM batched WHERE batch >= 3
      QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY batch DESC, event_id DESC) = 1
    """,
}
