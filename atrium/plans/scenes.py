"""Scenes derived from the driver's tables: the same SQL text for Spark and for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: In order of dependence; {table} stands for a table or a view above.
VIEWS = {
    "rooms": """SELECT CAST(FLOOR(p_partkey / 80.0) AS INT) AS scene_id, CAST(FLOOR(p_partkey / 16.0) AS BIGINT) AS room_id,
        CAST(6 * (FLOOR(p_partkey / 16.0) % 5) AS DOUBLE) AS x0, CAST(6 * (FLOOR(p_partkey / 16.0) % 5) + 6 AS DOUBLE) AS x1,
        CAST(0 AS DOUBLE) AS y0, CAST(5 AS DOUBLE) AS y1 FROM {part} WHERE p_partkey % 16 = 0""",
    "portals": """SELECT a.scene_id, a.room_id * 10 + b.room_id - a.room_id AS portal_id, a.room_id AS room_a, b.room_id AS room_b, a.x1 AS x, CAST(2.5 AS DOUBLE) AS y, CAST(1.0 AS DOUBLE) AS z,
        CAST(1.0 AS DOUBLE) AS nx, CAST(0.0 AS DOUBLE) AS ny, (50 + (a.room_id * 17) % 60) / CAST(100 AS DOUBLE) AS width, 'DOOR' AS type
        FROM {rooms} a JOIN {rooms} b ON a.scene_id = b.scene_id AND (b.room_id = a.room_id + 1 OR (a.scene_id % 3 = 0 AND a.room_id % 5 = 0 AND b.room_id = a.room_id + 3))""",
    "centers": """SELECT CAST(FLOOR(p_partkey / 80.0) AS INT) AS scene_id, CAST(p_partkey AS BIGINT) AS object_id,
        CASE WHEN FLOOR(p_partkey / 16.0) % 4 = 1 AND p_partkey % 16 < 7 THEN 'chair' ELSE CASE CAST((p_partkey * 13 + FLOOR(p_partkey / 16.0) * 5 + FLOOR(p_partkey / 3.0)) AS BIGINT) % 21
             WHEN 0 THEN 'chair' WHEN 1 THEN 'armchair' WHEN 2 THEN 'stool' WHEN 3 THEN 'sofa' WHEN 4 THEN 'table' WHEN 5 THEN 'coffee table'
             WHEN 6 THEN 'desk' WHEN 7 THEN 'bed' WHEN 8 THEN 'wardrobe' WHEN 9 THEN 'cabinet' WHEN 10 THEN 'bookshelf' WHEN 11 THEN 'lamp'
             WHEN 12 THEN 'table lamp' WHEN 13 THEN 'plant' WHEN 14 THEN 'vase' WHEN 15 THEN 'book' WHEN 16 THEN 'cup' WHEN 17 THEN 'tv'
             WHEN 18 THEN 'toilet' WHEN 19 THEN 'basin' ELSE 'box' END END AS label,
        6 * (FLOOR(p_partkey / 16.0) % 5) + CAST(0.75 AS DOUBLE) + ((p_partkey * 37) % 450) / CAST(100 AS DOUBLE) AS cx,
        CAST(0.75 AS DOUBLE) + ((p_partkey * 53) % 350) / CAST(100 AS DOUBLE) AS cy,
        CASE WHEN p_partkey % 3 = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS z0,
        (20 + (p_partkey * 7) % 60) / CAST(200 AS DOUBLE) AS hx,
        (20 + (p_partkey * 11) % 60) / CAST(200 AS DOUBLE) AS hy,
        CASE WHEN p_partkey % 3 = 1 THEN CAST(0.25 AS DOUBLE) ELSE (10 + (p_partkey * 13) % 100) / CAST(200 AS DOUBLE) END AS hz FROM {part}""",
    "objects": """SELECT scene_id, object_id, label, cx - hx AS min_x, cx + hx AS max_x, cy - hy AS min_y, cy + hy AS max_y,
        z0 AS min_z, z0 + 2 * hz AS max_z FROM {centers}""",
    "walls": """SELECT scene_id, -4 * room_id - 1 AS object_id, 'wall' AS label, x0 AS min_x, x1 AS max_x, y0 - CAST(0.1 AS DOUBLE) AS min_y, y0 + CAST(0.1 AS DOUBLE) AS max_y, CAST(0 AS DOUBLE) AS min_z, CAST(2.8 AS DOUBLE) AS max_z FROM {rooms}
        UNION ALL SELECT scene_id, -4 * room_id - 2, 'wall', x0, x1, y1 - CAST(0.1 AS DOUBLE), y1 + CAST(0.1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(2.8 AS DOUBLE) FROM {rooms}
        UNION ALL SELECT scene_id, -4 * room_id - 3, 'wall', x1 - CAST(0.1 AS DOUBLE), x1 + CAST(0.1 AS DOUBLE), y0, CAST(1.9 AS DOUBLE), CAST(0 AS DOUBLE), CAST(2.8 AS DOUBLE) FROM {rooms}
        UNION ALL SELECT scene_id, -4 * room_id - 4, 'wall', x1 - CAST(0.1 AS DOUBLE), x1 + CAST(0.1 AS DOUBLE), CAST(3.1 AS DOUBLE), y1, CAST(0 AS DOUBLE), CAST(2.8 AS DOUBLE) FROM {rooms}""",
    "views": """SELECT v.*, px + 2 * fx AS tx, py + 2 * fy AS ty FROM (SELECT CAST(FLOOR(o_custkey / 60.0) AS INT) AS scene_id, CAST(o_orderkey AS BIGINT) AS view_id,
        6 * (o_orderkey % 5) + CAST(0.25 AS DOUBLE) + ((o_orderkey * 41) % 550) / CAST(100 AS DOUBLE) AS px,
        CAST(0.25 AS DOUBLE) + ((o_orderkey * 29) % 450) / CAST(100 AS DOUBLE) AS py, CAST(0.8 AS DOUBLE) + (o_orderkey % 3) / CAST(10 AS DOUBLE) AS pz,
        CAST(CASE o_orderkey % 4 WHEN 0 THEN 0.6 WHEN 1 THEN -0.8 WHEN 2 THEN -0.6 ELSE 0.8 END AS DOUBLE) AS fx,
        CAST(CASE o_orderkey % 4 WHEN 0 THEN 0.8 WHEN 1 THEN 0.6 WHEN 2 THEN -0.8 ELSE -0.6 END AS DOUBLE) AS fy,
        CAST(0.4 AS DOUBLE) + (o_orderkey % 7) / CAST(10 AS DOUBLE) AS tz FROM {orders}) v""",
    "traj_steps": """SELECT user_id AS task_id, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS step,
        ((event_id * 37) % 600) / CAST(100 AS DOUBLE) AS px, ((event_id * 53) % 500) / CAST(100 AS DOUBLE) AS py,
        CASE event_id % 4 WHEN 0 THEN 'move_forward' WHEN 1 THEN 'turn_left' WHEN 2 THEN 'move_left' ELSE 'turn_right' END AS action
        FROM {events}""",
    "results": """SELECT o_orderkey AS question_id, o_orderpriority AS question_type, CAST(o_orderkey % 10 AS VARCHAR(10)) AS ground_truth,
        CAST(o_orderkey % 10 + (o_orderkey % 3) AS VARCHAR(10)) AS model_prediction FROM {orders}""",
    "pred_rows": """SELECT l_orderkey AS task_id, l_linenumber AS step, CAST(l_suppkey % 3 AS INT) AS slot_id,
        CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_partkey % 4 <> 0 END AS ok FROM {lineitem}""",
}
TABLES = ("nation", "part", "orders", "events", "lineitem", "customer", "supplier", "region", "documents")


def scene(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named views as DataFrames; filters and column selections reach the table scans below them."""
    made: dict[str, DataFrame] = {}

    def make(name: str) -> DataFrame:
        if name not in made:
            if name in TABLES:
                made[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            else:
                made[name] = spark.sql(VIEWS[name], **{n: make(n) for n in needs(name)})
        return made[name]

    return [make(n) for n in names]


def needs(name: str) -> list[str]:
    return [n for n in (*TABLES, *VIEWS) if "{" + n + "}" in VIEWS[name]]


def ctes(query: str) -> str:
    """The oracle's text: the views that the query names, then the query."""
    wanted: list[str] = []

    def want(name: str) -> None:
        if name in VIEWS and name not in wanted:
            for n in needs(name):
                want(n)
            wanted.append(name)

    for name in VIEWS:
        if "{" + name + "}" in query:
            want(name)
    plain = {n: n for n in (*TABLES, *VIEWS)}
    views = ",\n".join(f"{n} AS ({VIEWS[n].format(**plain)})" for n in wanted)
    head = query.lstrip()
    rest = query.format(**plain)
    if not views:
        return rest
    for start in ("WITH RECURSIVE ", "WITH "):
        if head.upper().startswith(start):
            return f"{start}{views},\n{rest.lstrip()[len(start):]}"
    return f"WITH {views}\n{rest}"
