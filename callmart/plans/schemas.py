"""Declared columns at the pipeline boundaries."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

_TYPES = {"bigint": LongType(), "int": IntegerType(), "string": StringType(), "time": TimestampNTZType()}
_CALL_LOG = {
    "interaction_id": "bigint",
    "callid": "string",
    "cuid": "bigint",
    "phone_number": "string",
    "dtime_call_start": "time",
    "dtime_call_end": "time",
    "weekday": "string",
    "h_date": "int",
    "day_part": "string",
    "talk_duration": "bigint",
    "interaction_type_code": "string",
    "code_call_result_type": "string",
    "response_name": "string",
    "code_camp_task_type": "string",
    "name_call_campaign": "string",
    "code_camp_task_result_type": "string",
    "text_call_disposition": "string",
    "call_source": "string",
    "part_date": "int",
}
CALL_LOG = StructType([StructField(name, _TYPES[t]) for name, t in _CALL_LOG.items()])

# What the second, narrower call source holds in place of columns it does not have.
SECOND_SOURCE_DEFAULTS = {
    "interaction_id": -1,
    "callid": "",
    "response_name": "",
    "code_camp_task_type": "",
    "name_call_campaign": "",
    "code_camp_task_result_type": "",
    "text_call_disposition": "",
}
