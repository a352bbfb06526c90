"""SQL statements the cohort queries are checked by.

They restate each step on whole relations with quantified and correlated
subqueries, unlike the aggregates, buckets and stages of the pipeline.
"""

from __future__ import annotations

from tallyward.sources.roles import role_ctes


_STEPS: list[tuple[str, str]] = [
    ("bound", """
        SELECT TIMESTAMP '{start}' AS s0, TIMESTAMP '{start}' + INTERVAL 12 MONTH AS s1,
          TIMESTAMP '{start}' - INTERVAL 50 YEAR AS w0, TIMESTAMP '{start}' - INTERVAL 30 DAY AS e0"""),
    ("hit10", "SELECT ICD10SID FROM dim_icd10 WHERE regexp_matches(ICD10Code, '{icd10}', 'i')"),
    ("hit9", "SELECT ICD9SID FROM dim_icd9 WHERE regexp_matches(ICD9Code, '^({icd9})', 'i')"),
    ("dx", """
        SELECT PatientSSN, v.PatientSID, VisitSID AS DiagnosisEventSID, VisitDateTime AS DiagnosisEventDateTime,
          'ZZZ NOT CAPTURED' AS TypeOfCancer, 'ZZZ NOT CAPTURED' AS StageOfCancer,
          'OUTPATIENT ENCOUNTER' AS TypeOfEvent
        FROM outpat_workload v JOIN spatient p ON p.PatientSID = v.PatientSID
        WHERE VisitSID IN (SELECT b.VisitSID FROM outpat_workload_vdiagnosis b
          WHERE b.ICD10SID IN (FROM hit10) OR b.ICD9SID IN (FROM hit9))
        UNION
        SELECT PatientSSN, v.PatientSID, InpatientSID, AdmitDateTime,
          'ZZZ NOT CAPTURED', 'ZZZ NOT CAPTURED', 'INPATIENT ENCOUNTER'
        FROM inpat_inpatient v JOIN spatient p ON p.PatientSID = v.PatientSID
        WHERE InpatientSID IN (SELECT b.InpatientSID FROM inpat_inpatient_diagnosis b
          WHERE b.ICD10SID IN (FROM hit10) OR b.ICD9SID IN (FROM hit9))
        UNION
        SELECT PatientSSN, v.PatientSID, OncologyPrimaryIEN, DateDX,
          coalesce(Histologyicdo3X, '') || ' OF THE ' || coalesce(ICDOSite, ''), StageGroupingajcc,
          'REGISTRY ENTRY'
        FROM oncology_primary v JOIN spatient p ON p.PatientSID = v.PatientSID
        WHERE regexp_matches(concat_ws('|', '', SitegpX, ICDOSite, PrimarysiteX), '\\|({site})', 'i')"""),
    ("cases", "SELECT dx.* FROM dx, bound WHERE DiagnosisEventDateTime BETWEEN s0 AND s1"),
    ("prior", """
        SELECT dx.* FROM dx, bound WHERE DiagnosisEventDateTime BETWEEN w0 AND s0
          AND PatientSID IN (SELECT PatientSID FROM cases)"""),
    ("incident", """
        SELECT * FROM cases WHERE PatientSSN NOT IN (
          SELECT c.PatientSSN FROM cases c WHERE EXISTS (
            SELECT 1 FROM prior p WHERE p.PatientSSN = c.PatientSSN))"""),
    ("preferred", """
        SELECT * FROM incident WHERE TypeOfEvent = 'REGISTRY ENTRY'
        UNION SELECT * FROM incident WHERE PatientSSN NOT IN (
          SELECT r.PatientSSN FROM incident r WHERE r.TypeOfEvent = 'REGISTRY ENTRY')"""),
    ("indexed", """
        SELECT DISTINCT * FROM preferred a WHERE PatientSSN IS NOT NULL AND NOT EXISTS (
          SELECT 1 FROM preferred b WHERE b.PatientSSN = a.PatientSSN
            AND b.DiagnosisEventDateTime < a.DiagnosisEventDateTime)"""),
    ("stays", """
        SELECT DISTINCT PatientSSN, i.PatientSID, InpatientSID AS ECEventSID, AdmitDateTime AS ECEventDateTime,
          'INPATIENT' AS TypeOfEvent
        FROM inpat_inpatient i JOIN spatient p ON p.PatientSID = i.PatientSID, bound
        WHERE AdmitDateTime BETWEEN e0 AND s1 AND PatientSSN IN (SELECT PatientSSN FROM indexed)"""),
    ("planned", """
        SELECT DISTINCT PatientSSN, ECEventSID FROM stays WHERE
          ECEventSID IN (SELECT InpatientSID FROM inpat_inpatient_diagnosis JOIN dim_icd10 USING (ICD10SID)
            WHERE upper(replace(ICD10Code, '.', '')) IN (SELECT upper(rtrim(code)) FROM planned_conditions))
          OR ECEventSID IN (SELECT InpatientSID
            FROM inpat_inpatient_icd_procedure JOIN dim_icd10_procedure USING (ICD10ProcedureSID)
            WHERE upper(replace(ICD10ProcedureCode, '.', '')) IN (
              SELECT upper(rtrim(code)) FROM planned_procedures_always
              UNION ALL SELECT upper(rtrim(code)) FROM planned_procedures_sometimes))"""),
    ("ed", """
        SELECT DISTINCT PatientSSN, e.PatientSID, VisitSID AS ECEventSID,
          PatientArrivalDateTime AS ECEventDateTime, 'ED-Treat-and-Release' AS TypeOfEvent,
          DispositionDateTime AS ECEventEndDateTime
        FROM edis_edislog e JOIN spatient p ON p.PatientSID = e.PatientSID, bound
        WHERE PatientArrivalDateTime BETWEEN e0 AND s1 AND VisitSID <> -1
          AND PatientSSN IN (SELECT PatientSSN FROM indexed)"""),
    ("follow", """
        SELECT PatientSSN, PatientSID, ECEventSID AS InpSID, ECEventDateTime AS InpDateTime
        FROM stays WHERE ECEventSID <> -1"""),
    ("admitted", """
        SELECT DISTINCT ECEventSID FROM ed JOIN follow ON follow.PatientSID = ed.PatientSID
          AND InpDateTime >= ECEventEndDateTime AND InpDateTime <= ECEventEndDateTime + INTERVAL 24 HOUR"""),
    ("released", "SELECT * FROM ed WHERE ECEventSID NOT IN (SELECT ECEventSID FROM admitted)"),
    ("emergency", """
        SELECT * FROM stays WHERE ECEventSID NOT IN (SELECT ECEventSID FROM planned)
        UNION ALL SELECT * EXCLUDE (ECEventEndDateTime) FROM released"""),
    ("dyad", """
        SELECT DISTINCT x.* RENAME (TypeOfEvent AS DiagnosisTypeOfEvent), e.ECEventSID, e.ECEventDateTime,
          e.TypeOfEvent AS ECTypeOfEvent
        FROM indexed x JOIN emergency e ON e.PatientSSN = x.PatientSSN
          AND e.ECEventDateTime >= x.DiagnosisEventDateTime - INTERVAL 30 DAY
          AND e.ECEventDateTime <= x.DiagnosisEventDateTime"""),
    ("last_dyad", """
        SELECT * FROM dyad a WHERE NOT EXISTS (SELECT 1 FROM dyad b
          WHERE b.PatientSSN = a.PatientSSN AND b.ECEventDateTime > a.ECEventDateTime)"""),
    ("pcp", """
        SELECT PatientSSN, VisitSID AS HistoricalEventSID, VisitDateTime AS HistoricalEventDateTime
        FROM outpat_workload v JOIN spatient p ON p.PatientSID = v.PatientSID
        WHERE v.PatientSID <> -1 AND EXISTS (SELECT 1
          FROM dim_stopcode one JOIN dim_stopcode two ON two.StopCodeSID = one.StopCodeSID
          WHERE one.StopCodeSID = v.PrimaryStopCodeSID
            AND (one.StopCode IN ({pcp}) OR two.StopCode IN ({pcp}))
            AND coalesce(two.StopCode, 0) NOT IN ({never}))"""),
]

COLORECTAL = ("C18|C19|C20", r"153|154\.0|154\.1", "COLO|RECT")
LUNG = ("C34", "162", "LUNG")
PROSTATE = ("C61", "185", "PROSTATE")
"""Patterns of each condition: ICD-10 anywhere, ICD-9 and registry sites at the beginning."""

_PCP = "301, 322, 323, 348, 350, 531, 534, 539"
_NEVER = "107, 115, 152, 311, 321, 328, 329, 333, 334, 430, 435, 474, 999"

# For each output, its inclusion relation; the same history steps follow both.
_HISTORY = """
    {p}_included AS ({included}),
    {p}_history AS (SELECT DISTINCT i.*, HistoricalEventSID, HistoricalEventDateTime, 'PCP' AS HistoricalTypeOfEvent
      FROM {p}_included i JOIN pcp ON pcp.PatientSSN = i.PatientSSN),
    {p}_first AS (SELECT h.*, date_diff('month', HistoricalEventDateTime, DiagnosisEventDateTime)::INTEGER AS DxHxDelta
      FROM {p}_history h WHERE HistoricalEventDateTime IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p}_history g
        WHERE g.PatientSSN = h.PatientSSN AND (g.HistoricalEventDateTime IS NULL
          OR g.HistoricalEventDateTime < h.HistoricalEventDateTime))),
    {p}_last AS (SELECT h.*, date_diff('month', HistoricalEventDateTime, DiagnosisEventDateTime)::INTEGER AS DxHxDelta
      FROM {p}_history h WHERE HistoricalEventDateTime IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p}_history g
        WHERE g.PatientSSN = h.PatientSSN AND g.HistoricalEventDateTime > h.HistoricalEventDateTime)),
    {p}_flagged AS (SELECT DISTINCT i.*, (f.DxHxDelta > 24)::INTEGER AS HasPCPBeforeCutOff,
        (l.DxHxDelta < 24)::INTEGER AS HasPCPAfterCutOff
      FROM {p}_included i
      JOIN {p}_first f ON f.PatientSSN = i.PatientSSN AND f.DiagnosisEventSID = i.DiagnosisEventSID
      JOIN {p}_last l ON l.PatientSSN = i.PatientSSN AND l.DiagnosisEventSID = i.DiagnosisEventSID),
    {p}_active AS (SELECT * FROM {p}_flagged WHERE HasPCPAfterCutOff = 1)"""

_PLACE = "'''' || coalesce({s}.City, '') || ', ''' || coalesce({t}.State, '')"
_RACE = """CASE WHEN upper(rtrim(Ethnicity)) = 'HISPANIC OR LATINO' THEN 'HISPANIC'
        WHEN upper(rtrim(Race)) LIKE 'WHITE' OR upper(rtrim(Race)) = 'WHITE NOT OF HISP ORIG' THEN 'WHITE'
        WHEN upper(rtrim(Race)) = 'BLACK OR AFRICAN AMERICAN' THEN 'BLACK' ELSE 'OTHER' END"""

_OUTPUT = """
    {p}_output AS (SELECT DISTINCT '''' || coalesce(a.PatientSSN, '') || '''' AS PatientSSN,
        a.DiagnosisEventDateTime::DATE AS DiagnosticEventDateTime,
        {dx_place} AS DiagnosisEventLocation, TypeOfCancer, StageOfCancer,
        DiagnosisTypeOfEvent AS TypeOfDiagnosisEvent, {ec_columns}
        HasPCPBeforeCutOff, HasPCPAfterCutOff, DeathDateTime, Gender AS PatientSex,
        date_diff('year', BirthDateTime, a.DiagnosisEventDateTime)::INTEGER AS PatientAge,
        {race} AS PatientRace
      FROM {p}_active a
      LEFT JOIN oncology_primary r ON DiagnosisTypeOfEvent = 'REGISTRY ENTRY'
        AND r.OncologyPrimaryIEN = a.DiagnosisEventSID AND r.PatientSID = a.PatientSID
        AND r.DateDX = a.DiagnosisEventDateTime
      LEFT JOIN inpat_inpatient i ON DiagnosisTypeOfEvent = 'INPATIENT ENCOUNTER'
        AND i.InpatientSID = a.DiagnosisEventSID
      LEFT JOIN outpat_workload o ON DiagnosisTypeOfEvent = 'OUTPATIENT ENCOUNTER'
        AND o.VisitSID = a.DiagnosisEventSID
      LEFT JOIN dim_sta3n ds ON ds.Sta3n = coalesce(r.Sta3n, i.Sta3n, o.Sta3n)
      LEFT JOIN dim_state dt ON dt.StateSID = ds.StateSID {ec_joins}
      JOIN spatient p ON p.PatientSID = a.PatientSID
      JOIN patient_race pr ON pr.PatientSID = a.PatientSID
      JOIN patient_ethnicity pe ON pe.PatientSID = a.PatientSID)"""

_EC_JOINS = """
      LEFT JOIN inpat_inpatient ei ON ECTypeOfEvent = 'INPATIENT' AND ei.InpatientSID = a.ECEventSID
      LEFT JOIN edis_edislog ee ON ECTypeOfEvent = 'ED-Treat-and-Release' AND ee.VisitSID = a.ECEventSID
      LEFT JOIN dim_sta3n es ON es.Sta3n = coalesce(ei.Sta3n, ee.Sta3n)
      LEFT JOIN dim_state et ON et.StateSID = es.StateSID"""


def cohort_sql(
    select: str, *, roles: bool = True, start: str = "2000-01-01", condition: tuple[str, str, str] = COLORECTAL,
) -> str:
    """``select`` over the steps above.

    With ``roles`` the warehouse relations are derived from the star-schema
    tables; without, they are expected to exist under their own names.
    """
    parts = [role_ctes()] if roles else []
    for name, body in _STEPS:
        body = body.replace("{start}", start).replace("{pcp}", _PCP).replace("{never}", _NEVER)
        for name_, patterns in zip(("{icd10}", "{icd9}", "{site}"), condition, strict=True):
            body = body.replace(name_, patterns)
        parts.append(f"{name} AS ({body})")
    dx_place = _PLACE.format(s="ds", t="dt")
    ec_columns = (
        "a.ECEventDateTime::DATE AS EmergencyEventDate,"
        f" {_PLACE.format(s='es', t='et')} AS EmergencyEventLocation,"
        " ECTypeOfEvent AS TypeOfEmergencyEvent,"
    )
    included = "SELECT * RENAME (TypeOfEvent AS DiagnosisTypeOfEvent) FROM indexed"
    parts.append(_HISTORY.format(p="den", included=included))
    parts.append(_HISTORY.format(p="num", included="SELECT * FROM last_dyad"))
    parts.append(_OUTPUT.format(p="den", dx_place=dx_place, race=_RACE, ec_columns="", ec_joins=""))
    parts.append(_OUTPUT.format(p="num", dx_place=dx_place, race=_RACE, ec_columns=ec_columns, ec_joins=_EC_JOINS))
    return "WITH " + ",\n".join(parts) + "\n" + select


SUMMARY = """
    SELECT *, stage_i + stage_ii AS ls_early, stage_iii + stage_iv AS ls_late FROM (SELECT (SELECT count(DISTINCT PatientSSN) FROM den_output WHERE {reg}) AS denominator,
      (SELECT count(DISTINCT PatientSSN) FROM num_output WHERE {reg}) AS ep_cases,
      (SELECT count(DISTINCT PatientSSN) FROM den_output WHERE {reg} AND {stage} = 'I') AS stage_i,
      (SELECT count(DISTINCT PatientSSN) FROM den_output WHERE {reg} AND {stage} = 'II') AS stage_ii,
      (SELECT count(DISTINCT PatientSSN) FROM den_output WHERE {reg} AND {stage} = 'III') AS stage_iii,
      (SELECT count(DISTINCT PatientSSN) FROM den_output WHERE {reg} AND {stage} = 'IV') AS stage_iv,
      (SELECT count(DISTINCT PatientSSN) FROM den_output WHERE {reg}
        AND coalesce({stage}, '') NOT IN ('I', 'II', 'III', 'IV')) AS stage_other) AS counts""".format(
    reg="TypeOfDiagnosisEvent = 'REGISTRY ENTRY'", stage="upper(rtrim(StageOfCancer))"
)
