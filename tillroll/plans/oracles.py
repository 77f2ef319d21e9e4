"""The same results in DuckDB SQL, over the same Parquet tables.

These are written as the plain joins and aggregates whose results the Spark side must
give, not after the Spark plans.
"""

from __future__ import annotations

VIEWS = """
WITH retail_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
           cast(o_orderdate AS varchar) AS order_purchase_timestamp
    FROM orders
), retail_items AS (
    SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
           l_suppkey AS seller_id, cast(l_shipdate AS varchar) AS shipping_limit_date,
           l_extendedprice AS price, l_quantity AS freight_value
    FROM lineitem
), retail_reviews AS (
    SELECT event_id AS review_id,
           CASE WHEN event_id % 10 = 0 THEN event_id + 1 ELSE event_id END AS order_id,
           CASE WHEN event_type = 'error' THEN NULL
                ELSE cast(floor(value) AS integer) % 5 + 1 END AS review_score,
           cast(ts AS varchar) AS review_creation_date
    FROM events
)
"""


def exact_sum(amount: str) -> str:
    return f"cast(sum(cast({amount} AS decimal(14, 2))) AS double)"


def exact_mean(amount: str, count: str | None = None) -> str:
    """Mean of a non-negative amount rounded half up to cents, in whole cents."""
    count = count or f"count({amount})"
    cents = f"sum(cast(round(({amount}) * 100) AS bigint))"
    return f"cast((2 * {cents} + {count}) // (2 * {count}) AS double) / 100"


ORDER_METRICS = f"""
, order_metrics AS (
    SELECT o.order_id, o.customer_id, o.order_status,
           {exact_sum('i.price')} AS spend_total,
           {exact_sum('i.freight_value')} AS freight_total,
           cast(count(i.order_item_id) AS double) AS item_count,
           cast(avg(r.review_score) AS double) AS avg_score
    FROM retail_orders o
    JOIN retail_items i ON o.order_id = i.order_id
    LEFT JOIN retail_reviews r ON o.order_id = r.order_id
    GROUP BY o.order_id, o.customer_id, o.order_status
), clean AS (
    SELECT * FROM order_metrics
    WHERE spend_total IS NOT NULL AND freight_total IS NOT NULL AND item_count IS NOT NULL
      AND avg_score IS NOT NULL AND order_status IS NOT NULL
), labelled AS (
    SELECT *, CASE WHEN avg_score >= 4 THEN 1.0::double ELSE 0.0::double END AS satisfied
    FROM clean
)
"""

STATUS_INDEX = """
, status_index AS (
    SELECT order_status,
           cast(row_number() OVER (ORDER BY count(*) DESC, order_status) - 1 AS double)
               AS status_index
    FROM clean GROUP BY order_status
), indexed AS (
    SELECT clean.*, status_index FROM clean JOIN status_index USING (order_status)
)
"""

SCALED = """
, moments AS (
    SELECT avg(spend_total) AS m1, stddev_samp(spend_total) AS s1,
           avg(freight_total) AS m2, stddev_samp(freight_total) AS s2,
           avg(item_count) AS m3, stddev_samp(item_count) AS s3,
           avg(status_index) AS m4, stddev_samp(status_index) AS s4
    FROM indexed
), scaled AS (
    SELECT order_id, status_index AS cluster,
           (spend_total - m1) / s1 AS z1, (freight_total - m2) / s2 AS z2,
           (item_count - m3) / s3 AS z3, (status_index - m4) / s4 AS z4
    FROM indexed, moments
)
"""

CONSOLIDATED = """
    SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.shipping_limit_date,
           i.price, i.freight_value, o.customer_id, o.order_status,
           o.order_purchase_timestamp, r.review_id, r.review_score, r.review_creation_date
    FROM retail_items i
    JOIN retail_orders o ON i.order_id = o.order_id
    LEFT JOIN retail_reviews r ON i.order_id = r.order_id
"""


def _types(table: str) -> str:
    return f"""
    SELECT '{table}' AS table_name, cast(ordinal AS integer) AS position, column_name AS col_name,
           CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
                ELSE lower(column_type) END AS data_type
    FROM (SELECT row_number() OVER () AS ordinal, *
          FROM (DESCRIBE {VIEWS} SELECT * FROM retail_{table}))
    """


PLANTED = """
, planted AS (
    SELECT order_id, order_status, avg_score, cast(order_id % 3 AS integer) AS cluster,
           spend_total + (order_id % 3) * 1e9::double AS spend_total,
           freight_total + (order_id % 3) * 1e6::double AS freight_total,
           item_count + (order_id % 3) * 1e4::double AS item_count
    FROM clean
), moments AS (
    SELECT avg(spend_total) AS m1, stddev_samp(spend_total) AS s1,
           avg(freight_total) AS m2, stddev_samp(freight_total) AS s2,
           avg(item_count) AS m3, stddev_samp(item_count) AS s3
    FROM planted
), points AS (
    SELECT order_id, cluster, (spend_total - m1) / s1 AS z1, (freight_total - m2) / s2 AS z2,
           (item_count - m3) / s3 AS z3
    FROM planted, moments
)
"""

TRAIN_SIDE = "cast('0x' || substr(md5(cast(order_id AS varchar)), 1, 8) AS bigint) % 10 < 8"

ORACLES: dict[str, str] = {
    "scan_text_lines": f"""{VIEWS}
        SELECT concat_ws(',', order_id, customer_id, order_status, order_purchase_timestamp)
            AS value
        FROM retail_orders""",
    "scan_csv_inferred": f"{VIEWS} SELECT * FROM retail_orders",
    "scan_csv_typed": f"""{VIEWS}
        SELECT cast(order_id AS varchar) AS order_id, order_item_id,
               cast(product_id AS varchar) AS product_id, cast(seller_id AS varchar) AS seller_id,
               shipping_limit_date, price, freight_value
        FROM retail_items""",
    "scan_csv_free_text": """
        SELECT cast(doc_id AS varchar) AS review_id,
               cast(n_chars % 5 + 1 AS integer) AS review_score,
               source AS review_comment_title, text AS review_comment_message
        FROM documents""",
    "parquet_roundtrip": f"{VIEWS} {ORDER_METRICS} SELECT * FROM order_metrics",
    "parquet_roundtrip_consolidated": f"{VIEWS} {CONSOLIDATED}",
    "sink_row_count": f"{VIEWS} {ORDER_METRICS} SELECT count(*) AS n_rows FROM order_metrics",
    "sql_sales_by_status": f"""{VIEWS}
        SELECT order_status, count(DISTINCT order_id) AS n_orders,
               {exact_sum('price')} AS sales_total
        FROM retail_orders JOIN retail_items USING (order_id)
        GROUP BY order_status""",
    "table_counts": f"""{VIEWS}
        SELECT 'orders' AS table_name, count(*) AS n_rows FROM retail_orders
        UNION ALL SELECT 'items', count(*) FROM retail_items
        UNION ALL SELECT 'reviews', count(*) FROM retail_reviews""",
    "head_n": f"{VIEWS} SELECT * FROM retail_orders ORDER BY order_id LIMIT 3",
    "first_row": f"""{VIEWS}
        SELECT * FROM retail_items
        ORDER BY order_id, order_item_id, product_id, seller_id, shipping_limit_date, price,
                 freight_value
        LIMIT 1""",
    "table_schemas": f"""
        SELECT t.*, n.n_rows
        FROM ({_types('orders')} UNION ALL {_types('items')} UNION ALL {_types('reviews')}) t
        JOIN (SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders
              UNION ALL SELECT 'items', count(*) FROM lineitem
              UNION ALL SELECT 'reviews', count(*) FROM events) n USING (table_name)""",
    "map_price": f"{VIEWS} SELECT price FROM retail_items",
    "item_sales_pairs": f"""{VIEWS}
        SELECT order_id, price + freight_value AS sale_total FROM retail_items""",
    "filter_premium": f"{VIEWS} SELECT * FROM retail_items WHERE price > 50000",
    "flatmap_ids": f"""{VIEWS}
        SELECT order_id AS id_value FROM retail_items
        UNION ALL SELECT product_id FROM retail_items""",
    "join_inner": f"""{VIEWS}
        SELECT o.order_id, customer_id, order_status, product_id, price
        FROM retail_orders o JOIN retail_items i ON o.order_id = i.order_id""",
    "join_left": f"""{VIEWS}
        SELECT o.order_id, order_status, review_id, review_score
        FROM retail_orders o LEFT JOIN retail_reviews r ON o.order_id = r.order_id""",
    "consolidated": f"{VIEWS} {CONSOLIDATED}",
    "product_counts": f"""{VIEWS}
        SELECT product_id, count(*) AS n_sold FROM retail_items GROUP BY product_id""",
    "order_sales": f"""{VIEWS}
        SELECT order_id, {exact_sum('price + freight_value')} AS sale_total
        FROM retail_items GROUP BY order_id""",
    "price_stats": f"""{VIEWS}
        SELECT count(price) AS n_values, {exact_sum('price')} AS sum_value,
               {exact_mean('price')} AS avg_value, round(stddev_samp(price), 2) AS stddev_value,
               round(min(price), 2) AS min_value, round(max(price), 2) AS max_value
        FROM retail_items""",
    "distinct_products": f"{VIEWS} SELECT DISTINCT product_id FROM retail_items",
    "top_items_by_price": f"""{VIEWS}
        SELECT product_id, price FROM retail_items ORDER BY price DESC, product_id LIMIT 10""",
    "top_orders": f"""{VIEWS}
        SELECT order_id, {exact_sum('price + freight_value')} AS sale_total
        FROM retail_items GROUP BY order_id ORDER BY sale_total DESC, order_id LIMIT 5""",
    "top_product_counts": f"""{VIEWS}
        SELECT product_id, count(*) AS n_sold FROM retail_items
        GROUP BY product_id ORDER BY n_sold DESC, product_id LIMIT 10""",
    "sales_by_status": f"""{VIEWS}
        SELECT o.order_status, count(DISTINCT o.order_id) AS n_orders,
               {exact_sum('i.price')} AS sales_total, {exact_mean('i.price')} AS avg_price
        FROM retail_orders o JOIN retail_items i ON o.order_id = i.order_id
        GROUP BY o.order_status
        ORDER BY sales_total DESC, o.order_status""",
    "top_products": f"""{VIEWS}
        SELECT product_id, count(*) AS n_sold, {exact_sum('price')} AS revenue,
               {exact_mean('price')} AS avg_price
        FROM retail_items GROUP BY product_id ORDER BY n_sold DESC, product_id LIMIT 10""",
    "score_distribution": f"""{VIEWS}
        SELECT review_score, count(*) AS n,
               cast(round(count(*) * 100.0 / (SELECT count(*) FROM retail_reviews), 2) AS double)
                   AS pct
        FROM retail_reviews WHERE review_score IS NOT NULL
        GROUP BY review_score ORDER BY review_score""",
    "top_customers": f"""{VIEWS}
        SELECT o.customer_id, count(DISTINCT o.order_id) AS n_orders,
               {exact_sum('i.price + i.freight_value')} AS spend_total,
               {exact_mean('i.price + i.freight_value')} AS avg_ticket
        FROM retail_orders o JOIN retail_items i ON o.order_id = i.order_id
        GROUP BY o.customer_id ORDER BY spend_total DESC, o.customer_id LIMIT 10""",
    "avg_ticket_per_order": f"""{VIEWS}
        SELECT o.customer_id, count(DISTINCT o.order_id) AS n_orders,
               {exact_sum('i.price + i.freight_value')} AS spend_total,
               {exact_mean('i.price + i.freight_value', 'count(DISTINCT o.order_id)')}
                   AS avg_ticket_per_order
        FROM retail_orders o JOIN retail_items i ON o.order_id = i.order_id
        GROUP BY o.customer_id ORDER BY spend_total DESC, o.customer_id LIMIT 10""",
    "monthly_sales": f"""{VIEWS}
        SELECT substr(o.order_purchase_timestamp, 1, 7) AS month,
               count(DISTINCT o.order_id) AS n_orders, {exact_sum('i.price')} AS sales_total
        FROM retail_orders o JOIN retail_items i ON o.order_id = i.order_id
        WHERE o.order_purchase_timestamp IS NOT NULL
        GROUP BY substr(o.order_purchase_timestamp, 1, 7) ORDER BY month""",
    "order_metrics": f"{VIEWS} {ORDER_METRICS} SELECT * FROM order_metrics",
    "order_metrics_no_fanout": f"""{VIEWS}
        SELECT o.order_id, o.customer_id, o.order_status,
               {exact_sum('i.price')} AS spend_total,
               {exact_sum('i.freight_value')} AS freight_total,
               cast(count(i.order_item_id) AS double) AS item_count,
               any_value(r.avg_score) AS avg_score
        FROM retail_orders o
        JOIN retail_items i ON o.order_id = i.order_id
        LEFT JOIN (SELECT order_id, avg(review_score) AS avg_score
                   FROM retail_reviews GROUP BY order_id) r ON o.order_id = r.order_id
        GROUP BY o.order_id, o.customer_id, o.order_status""",
    "clean_order_metrics": f"{VIEWS} {ORDER_METRICS} SELECT * FROM clean",
    "label_satisfied": f"""{VIEWS} {ORDER_METRICS}
        SELECT order_id, avg_score, satisfied FROM labelled""",
    "label_distribution": f"""{VIEWS} {ORDER_METRICS}
        SELECT satisfied, count(*) AS n FROM labelled GROUP BY satisfied""",
    "split_counts": f"""{VIEWS} {ORDER_METRICS}
        SELECT CASE WHEN cast('0x' || substr(md5(cast(order_id AS varchar)), 1, 8) AS bigint)
                         % 10 < 8 THEN 'train' ELSE 'test' END AS table_name,
               count(*) AS n_rows
        FROM labelled GROUP BY 1""",
    "ml_status_index": f"""{VIEWS} {ORDER_METRICS} {STATUS_INDEX}
        SELECT order_id, order_status, status_index FROM indexed""",
    "ml_scaled_features": f"""{VIEWS} {ORDER_METRICS} {STATUS_INDEX} {SCALED}
        SELECT order_id, round(z1, 6) + 0.0 AS z_spend, round(z2, 6) + 0.0 AS z_freight,
               round(z3, 6) + 0.0 AS z_items, round(z4, 6) + 0.0 AS z_status
        FROM scaled""",
    "eval_auc_fixed_score": f"""{VIEWS} {ORDER_METRICS}
        , ranked AS (
            SELECT satisfied, rank() OVER (ORDER BY spend_total)
                       + (count(*) OVER (PARTITION BY spend_total) - 1) / 2.0 AS mid_rank
            FROM labelled
        ), sides AS (
            SELECT sum(CASE WHEN satisfied = 1 THEN mid_rank END) AS rank_sum,
                   sum(satisfied) AS positives, sum(1 - satisfied) AS negatives
            FROM ranked
        )
        SELECT round((rank_sum - positives * (positives + 1) / 2) / (positives * negatives), 6)
            AS auc
        FROM sides""",
    "eval_accuracy_fixed_rule": f"""{VIEWS} {ORDER_METRICS}
        SELECT round(avg(CASE WHEN (item_count >= 4) = (satisfied = 1) THEN 1.0 ELSE 0.0 END), 6)
            AS accuracy
        FROM labelled""",
    "eval_majority_share": f"""{VIEWS} {ORDER_METRICS}
        SELECT round(greatest(avg(satisfied), avg(1 - satisfied)), 6) AS majority_share
        FROM labelled""",
    "eval_silhouette_fixed": f"""{VIEWS} {ORDER_METRICS} {STATUS_INDEX} {SCALED}
        , points AS (
            SELECT *, z1 * z1 + z2 * z2 + z3 * z3 + z4 * z4 AS norm FROM scaled
        ), clusters AS (
            SELECT cluster AS other, count(*) AS n, avg(norm) AS q, avg(z1) AS c1, avg(z2) AS c2,
                   avg(z3) AS c3, avg(z4) AS c4
            FROM points GROUP BY cluster
        ), distances AS (
            SELECT order_id, cluster, other, n,
                   norm + q - 2 * (z1 * c1 + z2 * c2 + z3 * c3 + z4 * c4) AS distance
            FROM points, clusters
        ), sides AS (
            SELECT order_id,
                   max(CASE WHEN other = cluster THEN n END) AS n,
                   max(CASE WHEN other = cluster AND n > 1 THEN distance * n / (n - 1) END) AS a,
                   min(CASE WHEN other <> cluster THEN distance END) AS b
            FROM distances GROUP BY order_id
        )
        SELECT round(avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6)
            AS silhouette
        FROM sides""",
    "kmeans_assign_fixed": f"""{VIEWS} {ORDER_METRICS}
        , distances AS (
            SELECT order_id,
                   [(spend_total - 50000) * (spend_total - 50000)
                        + (freight_total - 20) * (freight_total - 20)
                        + (item_count - 1) * (item_count - 1),
                    (spend_total - 150000) * (spend_total - 150000)
                        + (freight_total - 75) * (freight_total - 75)
                        + (item_count - 3) * (item_count - 3),
                    (spend_total - 300000) * (spend_total - 300000)
                        + (freight_total - 150) * (freight_total - 150)
                        + (item_count - 6) * (item_count - 6)] AS d
            FROM clean
        )
        SELECT order_id, cast(list_position(d, list_min(d)) - 1 AS integer) AS prediction
        FROM distances""",
    "profile_by_status": f"""{VIEWS} {ORDER_METRICS}
        SELECT order_status, count(*) AS n_orders, {exact_mean('spend_total')} AS avg_spend,
               {exact_mean('freight_total')} AS avg_freight,
               round(avg(item_count), 2) AS avg_items, round(avg(avg_score), 2) AS avg_score
        FROM clean GROUP BY order_status ORDER BY order_status""",
    "sink_manifest_check": f"""{VIEWS} {ORDER_METRICS}
        SELECT cast(count(*) AS bigint) AS n_rows, true AS all_parquet, true AS all_with_bytes
        FROM order_metrics""",
    "lr_gradient": f"""{VIEWS} {ORDER_METRICS}
        SELECT position, feature, 0.0::double AS slope, n_train
        FROM (VALUES (1, 'spend_total'), (2, 'freight_total'), (3, 'item_count'),
                     (4, 'status_index'), (5, 'intercept')) AS weights(position, feature),
             (SELECT count(*) AS n_train FROM labelled WHERE {TRAIN_SIDE})""",
    "lr_report_rows": f"""{VIEWS} {ORDER_METRICS}
        SELECT order_id, spend_total, avg_score, satisfied FROM labelled
        WHERE NOT ({TRAIN_SIDE})""",
    "lr_test_share": f"""{VIEWS} {ORDER_METRICS}
        SELECT count(*) AS n_test,
               round(greatest(avg(satisfied), avg(1 - satisfied)), 6) AS majority_share
        FROM labelled WHERE NOT ({TRAIN_SIDE})""",
    "kmeans_planted_best_k": f"""{VIEWS} {ORDER_METRICS} {PLANTED}
        , clusters AS (
            SELECT cluster AS other, count(*) AS n, avg(z1 * z1 + z2 * z2 + z3 * z3) AS q,
                   avg(z1) AS c1, avg(z2) AS c2, avg(z3) AS c3
            FROM points GROUP BY cluster
        ), distances AS (
            SELECT order_id, cluster, other, n,
                   z1 * z1 + z2 * z2 + z3 * z3 + q - 2 * (z1 * c1 + z2 * c2 + z3 * c3) AS distance
            FROM points, clusters
        ), sides AS (
            SELECT order_id,
                   max(CASE WHEN other = cluster THEN distance * n / (n - 1) END) AS a,
                   min(CASE WHEN other <> cluster THEN distance END) AS b
            FROM distances GROUP BY order_id
        )
        SELECT 3 AS k, round(avg((b - a) / greatest(a, b)), 5) AS silhouette FROM sides""",
    "kmeans_planted_assignments": f"""{VIEWS} {ORDER_METRICS} {PLANTED}
        SELECT order_id, cluster AS prediction FROM points""",
    "kmeans_planted_profile": f"""{VIEWS} {ORDER_METRICS} {PLANTED}
        SELECT cluster AS prediction, count(*) AS n_orders,
               {exact_mean('spend_total')} AS avg_spend,
               {exact_mean('freight_total')} AS avg_freight,
               {exact_mean('item_count')} AS avg_items, round(avg(avg_score), 2) AS avg_score
        FROM planted GROUP BY cluster ORDER BY cluster""",
    "kmeans_planted_centers": f"""{VIEWS} {ORDER_METRICS} {PLANTED}
        SELECT cluster AS prediction, round(avg(z1), 5) AS spend_total,
               round(avg(z2), 5) AS freight_total, round(avg(z3), 5) AS item_count
        FROM points GROUP BY cluster""",
    "ml_summary_check": """
        SELECT cast(count(*) AS bigint) AS n_rows, true AS scores_in_range, true AS k_in_range,
               true AS silhouette_in_range, true AS clusters_as_k
        FROM (SELECT count(*) FROM orders)""",
}

ORACLES["consolidated_spread"] = ORACLES["consolidated"]

REPORT_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_creation_date"],
}
REPORT_KEYS = {"orders": "order_id", "items": "order_id, order_item_id", "reviews": "review_id"}
REPORT_NUMERIC = {"items": ["price", "freight_value"], "reviews": ["review_score"]}


def _column_checks(table: str, position: int, column: str) -> str:
    """One row of the report: the column's nulls and quartiles, and the table's keys."""
    if column in REPORT_NUMERIC.get(table, ()):
        q1, median, q3 = (f"(SELECT quantile_disc({column}::double, {p}) FROM retail_{table})" for p in (0.25, 0.5, 0.75))
        outside = f"{column} < {q1} - 1.5 * ({q3} - {q1}) OR {column} > {q3} + 1.5 * ({q3} - {q1})"
        outliers = f"(SELECT count(*) FROM retail_{table} WHERE {outside})"
    else:
        q1 = median = q3 = "NULL::double"
        outliers = "NULL::bigint"
    keys = f"(SELECT DISTINCT {REPORT_KEYS[table]} FROM retail_{table})"
    return f"""
        SELECT '{table}' AS table_name, count(*) AS n_rows, {position} AS position,
               '{column}' AS col_name, count(*) - count({column}) AS n_nulls,
               {q1} AS q1, {median} AS median, {q3} AS q3, {outliers} AS n_outliers,
               0::bigint AS n_without_key, (SELECT count(*) FROM {keys}) AS n_keys,
               count(*) - (SELECT count(*) FROM {keys}) AS n_repeated
        FROM retail_{table}"""


DEDUPLICATED = """
, deduplicated AS (
    SELECT * FROM retail_items
    QUALIFY row_number() OVER (
        PARTITION BY order_id, order_item_id
        ORDER BY price DESC NULLS LAST, product_id NULLS FIRST, seller_id NULLS FIRST,
                 shipping_limit_date NULLS FIRST, freight_value NULLS FIRST) = 1
)
"""

ORACLES |= {
    "quality_report": VIEWS + " UNION ALL ".join(
        _column_checks(table, position, column)
        for table, columns in REPORT_COLUMNS.items()
        for position, column in enumerate(columns, start=1)
    ),
    "deduplicated_items": f"{VIEWS} {DEDUPLICATED} SELECT * FROM deduplicated",
    "sales_after_deduplication": f"""{VIEWS} {DEDUPLICATED}
        SELECT o.order_status, count(DISTINCT o.order_id) AS n_orders,
               {exact_sum('i.price')} AS sales_total, {exact_mean('i.price')} AS avg_price
        FROM retail_orders o JOIN deduplicated i ON o.order_id = i.order_id
        GROUP BY o.order_status
        ORDER BY sales_total DESC, o.order_status""",
    "event_sessions": f"""
        WITH marked AS (
            SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER visits <= 1800000000
                           THEN 0 ELSE 1 END AS begins
            FROM events WINDOW visits AS (PARTITION BY user_id ORDER BY ts, event_id)
        ), numbered AS (
            SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                        ROWS UNBOUNDED PRECEDING) AS session
            FROM marked
        )
        SELECT user_id, cast(session AS bigint) AS session,
               cast(min(ts) AS varchar) AS started, cast(max(ts) AS varchar) AS ended,
               count(*) AS n_events, count(*) FILTER (event_type = 'purchase') AS n_purchases,
               {exact_sum('value')} AS value_total
        FROM numbered GROUP BY user_id, session""",
    "visits_with_last_purchase": """
        SELECT e.event_id, e.user_id, p.event_id AS last_purchase_id, p.value AS last_value
        FROM events e
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
            ON e.user_id = p.user_id AND e.ts >= p.ts""",
}

ORACLES |= {
    "cumulative_sales": f"""{VIEWS}, sales AS (
            SELECT order_id, sum(cast(price + freight_value AS decimal(14, 2))) AS sale
            FROM retail_items GROUP BY order_id
        )
        SELECT order_id, order_purchase_timestamp, cast(sale AS double) AS sale_total,
               cast(sum(sale) OVER in_order AS double) AS running_total,
               row_number() OVER (ORDER BY order_purchase_timestamp, order_id) AS position
        FROM sales JOIN retail_orders USING (order_id)
        WINDOW in_order AS (ORDER BY order_purchase_timestamp, order_id ROWS UNBOUNDED PRECEDING)""",
    "sales_cube": f"""{VIEWS}
        SELECT o.order_status, substr(o.order_purchase_timestamp, 1, 7) AS month,
               cast(grouping(o.order_status, substr(o.order_purchase_timestamp, 1, 7)) AS bigint) AS level,
               count(*) AS n_items, {exact_sum('i.price')} AS sales_total
        FROM retail_items i JOIN retail_orders o ON i.order_id = o.order_id
        GROUP BY CUBE (o.order_status, substr(o.order_purchase_timestamp, 1, 7))""",
    "monthly_seasonality": f"""{VIEWS}, monthly AS (
            SELECT cast(substr(order_purchase_timestamp, 1, 7) || '-01' AS date) AS m,
                   {exact_sum('price')} AS sales
            FROM retail_orders JOIN retail_items USING (order_id)
            WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1
        ), filled AS (
            SELECT cast(c.m AS date) AS m, coalesce(sales, 0) AS sales
            FROM generate_series((SELECT min(m) FROM monthly), (SELECT max(m) FROM monthly), INTERVAL 1 MONTH) c(m)
            LEFT JOIN monthly ON monthly.m = cast(c.m AS date)
        ), trended AS (
            SELECT m, sales, CASE WHEN count(*) OVER wide = 13
                THEN (sum(sales) OVER wide + sum(sales) OVER narrow) / 24 END AS trend
            FROM filled
            WINDOW wide AS (ORDER BY m ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING),
                   narrow AS (ORDER BY m ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)
        ), shares AS (SELECT month(m) AS k, avg(sales / trend) AS share FROM trended GROUP BY 1),
        scaled AS (SELECT k, share / (SELECT avg(share) FROM shares) AS seasonal FROM shares)
        SELECT strftime(m, '%Y-%m') AS month, round(sales, 2) AS sales_total, round(trend, 2) AS trend,
               round(seasonal, 6) AS seasonal, round(sales / (trend * seasonal), 6) AS residual
        FROM trended JOIN scaled ON k = month(m)""",
}
