"""Table schemas.  The column names are an interface: they equal those of the stored tables."""

from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns):
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_STRING, _LONG, _INT = StringType(), LongType(), IntegerType()

USER_VISIT_ACTION = _schema(
    date=_STRING,
    user_id=_LONG,
    session_id=_STRING,
    page_id=_LONG,
    action_time=_STRING,
    search_keyword=_STRING,
    click_category_id=_STRING,
    click_product_id=_STRING,
    order_category_ids=_STRING,
    order_product_ids=_STRING,
    pay_category_ids=_STRING,
    pay_product_ids=_STRING,
    city_id=_INT,
)

USER_INFO = _schema(
    user_id=_LONG,
    user_name=_STRING,
    name=_STRING,
    age=_INT,
    professional=_STRING,
    city=_STRING,
    sex=_STRING,
)

PRODUCT_INFO = _schema(product_id=_LONG, product_name=_STRING, extend_info=_STRING)

CITY_INFO = _schema(city_id=_INT, city_name=_STRING, area=_STRING, province_name=_STRING)

TASK = _schema(
    task_id=_LONG,
    task_name=_STRING,
    create_time=_STRING,
    start_time=_STRING,
    finish_time=_STRING,
    task_type=_STRING,
    task_status=_STRING,
    task_param=_STRING,
)

AD_CLICK = _schema(
    ts=TimestampType(), province=_STRING, city=_STRING, user_id=_LONG, ad_id=_LONG
)

ACTION_COLUMNS = USER_VISIT_ACTION.fieldNames()
