"""Small hand-written frames."""

from sessionloom import schemas

CITIES = [
    (1, "上海", "华东", "上海"),
    (2, "杭州", "华东", "浙江"),
    (5, "北京", "华北", "北京"),
    (101, "上海", "华东", "上海"),
]


def action(session_id="s1", time="2024-01-01 09:00:00", **columns):
    row = dict.fromkeys(schemas.ACTION_COLUMNS, "")
    row.update(
        date=time[:10], user_id=1, session_id=session_id, page_id=1, action_time=time, city_id=1
    )
    row.update(columns)
    return tuple(row[name] for name in schemas.ACTION_COLUMNS)


def actions(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.USER_VISIT_ACTION)


def cities(spark, rows=CITIES):
    return spark.createDataFrame(rows, schemas.CITY_INFO)


def users(spark, *rows):
    """Rows of (user_id, age, professional, city, sex)."""
    return spark.createDataFrame(
        [(i, f"user_{i}", f"name_{i}", age, job, city, sex) for i, age, job, city, sex in rows],
        schemas.USER_INFO,
    )


def rows(df, *columns):
    return sorted(tuple(row) for row in (df.select(*columns) if columns else df).collect())
