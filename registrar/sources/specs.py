"""Table specs (S3, S4): staged table name -> ordered typed columns.

Each column is ``name type parser``. Types: text, integer, numeric, boolean,
date, uuid, text[], integer[], point, daterange. Parsers:
  text    P1 null-forcing text           keep  P2 non-null text ('' for NULL)
  date    P5 nullable date               flag  P4 numeric boolean (exactly 1)
  active  P3 activity flag (A)           code  P7 code number (0 = missing)
  number  P8 text to number              array P9 array literal
  tf      P10 t/f boolean
Every value is read as text and typed by (parser, type); unparsable numbers
become NULL (``try_cast``), so a bad field never aborts a load.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import parse as P

SQL_TYPES = {
    "text": "string", "integer": "int", "numeric": "decimal(18,4)", "boolean": "boolean",
    "date": "date", "uuid": "string", "text[]": "array<string>", "integer[]": "array<int>",
    "point": "struct<x:double,y:double>", "daterange": "struct<lower:date,upper:date>",
    "bigint": "bigint", "double": "double",
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    sql_type: str
    parser: str

    def expr(self, raw: Column) -> Column:
        """Typed value from the raw text column."""
        p, t = self.parser, self.sql_type
        if p == "date":
            return P.nullable_date(raw)
        if p == "flag":
            return P.numeric_boolean(raw)
        if p == "active":
            return P.activity_flag(raw)
        if p == "tf":
            return P.tf_boolean(raw)
        if p == "code":
            return P.code_number(raw).cast(SQL_TYPES[t])
        if p == "array":
            arr = P.array_literal(raw)
            return arr if t == "text[]" else F.transform(arr, lambda x: x.try_cast("int"))
        if p == "keep":
            return P.non_null_text(raw)
        if t == "point":
            return P.point_literal(raw)
        if t == "daterange":
            return P.range_literal(raw)
        if p == "number":
            return P.text_to_number(raw, SQL_TYPES[t])
        txt = P.null_forcing_text(raw)
        if t in ("text", "uuid"):
            return F.lower(txt) if t == "uuid" else txt
        if t == "boolean":
            return F.lower(F.trim(txt)).isin("1", "t", "true")
        return F.trim(txt).try_cast(SQL_TYPES[t])


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    primary_key: tuple[str, ...] = ()
    kind: str = "record"          # record file or delimited file
    exclusion_of: str | None = None
    element: str | None = None    # record element name when known in advance

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> ColumnSpec | None:
        for c in self.columns:
            if c.name == name:
                return c
        return None

    def ddl(self) -> str:
        return ", ".join(f"{c.name} {SQL_TYPES[c.sql_type]}" for c in self.columns)


def spec(name: str, text: str, pk=(), kind: str = "record", exclusion_of=None, element=None) -> TableSpec:
    cols = []
    for part in text.split(","):
        part = part.strip()
        if not part:
            continue
        n, t, p = part.split()
        cols.append(ColumnSpec(n, t, p))
    return TableSpec(name, tuple(cols), tuple(pk), kind, exclusion_of, element)


def _report_codes() -> str:
    # the 31 day columns of a journal row, built from their rule
    return ", ".join(f"reportcode{d:02d} integer text" for d in range(1, 32))


# Staged tables of the legacy record dumps, in mapping order.
RECORD_TABLES = [
    spec("applications", "personid text text, applicationdate date date, placeneed numeric text, "
         "specialhandlingtime numeric text, transferapplication boolean flag, status integer text, "
         "careid integer text, applicationtype integer text, guid text text", pk=["guid"]),
    spec("applicationrows", "personid text text, priority integer text, unitcode integer text, "
         "childminder text text, areacode text text, startdate date date, hours numeric text, "
         "childmindercare text text, unitcare integer text, days integer text, extent integer text, "
         "type text text, careid integer text, guid text text"),
    spec("codes", "code integer code, active boolean active, codetype text text, text text text, "
         "extrainfo1 text text, extrainfo2 text text, guid text text"),
    spec("families", "familynbr integer text, personid text text, startdate date date, enddate date date, "
         "roleinfamily text text, guid text text"),
    spec("income", "personid text text, startdate date date, enddate date date, maxincome boolean flag, "
         "incomemissing boolean flag, summa numeric text, guid text text"),
    spec("incomerows", "personid text text, startdate date date, enddate date date, incomeperiod integer text, "
         "incometype integer text, summa numeric text, guid text text"),
    spec("persons", "personid text text, personname text text, secretaddress boolean flag, "
         "personstreetaddress text text, personcity text text, personzipcode text text, "
         "personhomeemail text text, personmobilephone text text, phonehome text text, phonework text text, "
         "mothertongue integer code, nationality integer code, homemunicipality integer code, guid text text",
         pk=["guid"]),
    spec("specialneeds", "personid text text, specialneedcode integer text, startdate date date, "
         "enddate date date, specialneednbr integer text, guid text text"),
    spec("specialmeans", "personid text text, specialneedcode integer text, mean integer text, "
         "startdate date date, enddate date date, specialneednbr integer text, guid text text"),
    spec("areas", "areacode integer text, areaname text text, level integer text, parent integer text, "
         "guid text text"),
    spec("units", "unitcode integer code, unitname text text, startdate date date, enddate date date, "
         "unitaddress text text, unitzipcode text text, unitcity text text, unitemail text text, "
         "phone1 text text, unit24_7 boolean flag, areacode integer text, guid text text"),
    spec("departments", "unitcode integer code, departmentcode integer code, departmentname text text, "
         "startdate date date, enddate date date, departmentaddress text text, departmentzipcode text text, "
         "departmentcity text text, departmentemail text text, phone text text, guid text text"),
    spec("placements", "placementnbr integer text, personid text text, placementunitcode integer code, "
         "placementdepartmentcode integer code, placementchildminder text text, startdate date date, "
         "enddate date date, guid text text"),
    spec("placementextents", "placementnbr integer code, extentnbr integer code, startdate date date, "
         "enddate date date, hours numeric text, days integer text, extentcode integer code, guid text text"),
    spec("feedeviations", "placementnbr integer code, rownbr integer code, serviceform integer code, "
         "deviationtype integer code, startdate date date, enddate date date, sum numeric text, "
         "procent numeric text, hours numeric text, days integer text, extentcode integer code, guid text text"),
    spec("decisions", "personid text text, decisiontype integer code, decisionstatus integer code, "
         "decisionunitcode integer code, decisionchildminder text text, startdate date date, enddate date date, "
         "decisiondate date date, caseworker text text, decisionmaker text text, decisionnbr integer text, "
         "extent integer code, days integer text, paydecision numeric text, factor numeric text, "
         "ceiling numeric text, familysize integer text, sum numeric text, totalsum numeric text, "
         "grandtotal numeric text, guid text text", pk=["guid"]),
    spec("paydecisions", "headoffamily text text, internaldecisionnumber integer text, startdate date date, "
         "enddate date date, fee numeric text, caseworker text text, decisionmaker text text, "
         "decisionnumber integer text, decisiondate date date, status integer text, guid text text", pk=["guid"]),
    spec("paydecisionrows", "internalid integer text, rownumber integer text, person text text, "
         "income numeric text, specification text text, fee numeric text, rowtype integer text, guid text text",
         pk=["guid"]),
    spec("childminders", "personid text text, area integer code, startdate date date, enddate date date, "
         "phonenbr text text, email text text, guid text text"),
    spec("dailyjournals", "dailyjournalid integer text, unit integer text, department integer text, "
         "childminder text text, openingdays text text, period text text, guid text text"),
    spec("dailyjournalrows", "dailyjournalid integer text, personid text text, extrachild text text, "
         + _report_codes() + ", guid text text"),
    spec("timestampheaders", "rownumber integer text, childminder text text, period text text, rowtype text text, "
         "unit integer text, department integer text, personid text text, placementnumber integer text, "
         "guid text text"),
    spec("timestampdetails", "rownumber integer text, day integer text, starttime1 text text, endtime1 text text, "
         "starttime2 text text, endtime2 text text, starttime3 text text, endtime3 text text, guid text text"),
]

# Delimited mapping and target-dimension files, in mapping order.
DELIMITED_TABLES = [
    spec("evaka_areas", "id uuid text, name text text, short_name text text", kind="delimited"),
    spec("extentmap", "effica_id integer number, days integer text, evaka_id uuid text", kind="delimited"),
    spec("unitmap", "effica_id integer number, evaka_id uuid text", kind="delimited"),
    spec("childmindermap", "effica_id text text, evaka_id uuid text", kind="delimited"),
    spec("evaka_unit_manager", "id uuid text, name text text, phone text text, email text text", kind="delimited"),
    spec("evaka_daycare", "id uuid text, name text text, type text[] array, care_area_id uuid text, "
         "phone text text, url text text, backup_location text text, opening_date date date, "
         "closing_date date date, email text text, schedule text text, additional_info text text, "
         "cost_center text text, upload_to_varda boolean tf, decision_daycare_name text keep, "
         "decision_preschool_name text keep, street_address text keep, postal_code text keep, "
         "post_office text keep, mailing_po_box text text, location point text, "
         "mailing_street_address text text, mailing_postal_code text text, mailing_post_office text text, "
         "invoiced_by_municipality boolean tf, provider_type text text, language text text, "
         "upload_to_koski boolean tf, operation_days integer[] array, ghost_unit boolean tf, "
         "daycare_apply_period daterange text, preschool_apply_period daterange text, "
         "round_the_clock boolean tf, unit_manager_id uuid text", kind="delimited"),
    spec("daycare_oid_map", "evaka_id uuid text, unit_oid text text, organizer_oid text text, "
         "varda_unit_id integer number, name text text", kind="delimited"),
    spec("families_exclusion", "personid text text, familynbr integer number, roleinfamily text text, "
         "startdate date date, enddate date date", kind="delimited", exclusion_of="families"),
    spec("placements_exclusion", "placementnbr integer number", kind="delimited", exclusion_of="placements"),
    spec("incomerows_exclusion", "personid text text, startdate date date, enddate date date, "
         "incomeperiod integer text, incometype integer text, summa numeric text", kind="delimited",
         exclusion_of="incomerows"),
]

REGISTRY: dict[str, TableSpec] = {s.name: s for s in RECORD_TABLES + DELIMITED_TABLES}


def exclusion_for(table: str) -> TableSpec | None:
    for s in DELIMITED_TABLES:
        if s.exclusion_of == table:
            return s
    return None
