"""Declared column contracts of the stages and outputs (fixed names, types, lengths)."""

from __future__ import annotations

from pyspark.sql import types as T

_LONG, _INT, _STR = T.LongType(), T.IntegerType(), T.StringType()
_TIME, _DATE = T.TimestampNTZType(), T.DateType()


def _contract(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


STUDY_PARAMS = _contract(
    ("Search_Start", _TIME), ("Search_Length_Months", _INT), ("Exclude_Length_Years", _INT),
    ("Lookback_Length_Days", _INT), ("CareHx_Length_Months", _INT),
)

CASES = _contract(
    ("PatientSSN", T.VarcharType(10)), ("PatientSID", _LONG),
    ("DiagnosisEventSID", _LONG), ("DiagnosisEventDateTime", _TIME),
    ("TypeOfCancer", T.VarcharType(300)), ("StageOfCancer", T.VarcharType(100)),
    ("TypeOfEvent", T.VarcharType(50)),
)

EMERGENCY = _contract(
    ("PatientSSN", T.VarcharType(10)), ("PatientSID", _LONG),
    ("ECEventSID", _LONG), ("ECEventDateTime", _TIME), ("TypeOfEvent", T.VarcharType(50)),
)

_DIAGNOSIS = (
    ("PatientSSN", T.VarcharType(100)), ("DiagnosticEventDateTime", _DATE),
    ("DiagnosisEventLocation", T.VarcharType(200)), ("TypeOfCancer", T.VarcharType(300)),
    ("StageOfCancer", T.VarcharType(100)), ("TypeOfDiagnosisEvent", T.VarcharType(50)),
)
_EMERGENCY = (
    ("EmergencyEventDate", _DATE), ("EmergencyEventLocation", T.VarcharType(200)),
    ("TypeOfEmergencyEvent", T.VarcharType(50)),
)
_PERSON = (
    ("HasPCPBeforeCutOff", _INT), ("HasPCPAfterCutOff", _INT), ("DeathDateTime", _TIME),
    ("PatientSex", T.VarcharType(100)), ("PatientAge", _INT), ("PatientRace", T.VarcharType(100)),
)

DENOMINATOR_OUTPUT = _contract(*_DIAGNOSIS, *_PERSON)
NUMERATOR_OUTPUT = _contract(*_DIAGNOSIS, *_EMERGENCY, *_PERSON)
