"""Small tables that cover the edge cases of each analysis."""

from __future__ import annotations

from datetime import datetime

from tallyhouse.sources.schemas import HOUSES_RAW, PURCHASES, WEB_LOGS

# Inputs whose results are known.

# house_id, maintenance_year, square, population, region, locality_name, address, communal id
HOUSES = [
    (1, "1953.0", "585.60", "18", "R1", "T1", "a1", "7"),
    (2, "1957", "1 234.5", "—", "R1", "T1", "a2", ""),
    (3, "1961", "—", "1 000", "R1", None, "a3", "8"),
    (4, "1961", "100.0", "5", "R2", "T2", "b2", "9"),
    (5, "1969", "100.0", "6", "R2", "T2", "b1", "9"),
    (6, "205", "50.0", "1", "R2", "T2", "b3", "9"),
    (7, None, "60.0", "1", "R2", None, "b4", "9"),
    (8, "1970", "NaN", "1", None, None, "c\n1", "9"),
    (9, "2025", "70.0", "1", "R2", "T2", "b5", "9"),
]

LOGS = [
    ("1.1.1.1", "2024-10-09T00:00:00", "GET", "/a", 200, 100),
    ("1.1.1.1", "2024-10-09T23:59:59", "PUT", "/b", 404, 300),
    ("2.2.2.2", "2024-10-10T12:00:00", "GET", "/a", 404, 200),
    ("3.3.3.3", "2024-10-11T12:00:00", "POST", "/c", 500, 600),
]

ACCESS_LOG = """\
192.0.2.1 - - [01/Jan/2024:00:00:00 +0000] "GET /index.html HTTP/1.1" 200 10
192.0.2.10 - - [01/Jan/2024:00:00:01 +0000] "GET /index.html HTTP/1.1" 200 10
192.0.2.2 - - [01/Jan/2024:00:00:02 +0000] "POST /login HTTP/1.1" 200 10
192.0.2.1 - - [01/Jan/2024:00:00:03 +0000] "GET /about.html HTTP/1.1" 200 10
192.0.2.3 - - [01/Jan/2024:00:00:04 +0000] "GET /index.html HTTP/1.1" 200 10
192.0.2.1 - - [01/Jan/2024:00:00:05 +0000] "GET /about.html HTTP/1.1" 404 10
"""

PURCHASED = [
    ("apple", "fruit", 1.2, 10),
    ("banana", "fruit", 0.5, 5),
    ("milk", "dairy", 1.5, 2),
    ("bread", "bakery", 2.0, 3),
]

# Values on the bounds of the tests (60000 and 65000), a NULL and a tie.
STAFF = [
    ("Odile", "Welder", 65000, "2015-02-28"),
    ("Rui", "Porter", 59999, "2023-11-30"),
    ("Mara", "Clerk", 60000, "2012-07-04"),
    ("Tomas", "Clerk", 60000, "2016-12-31"),
    ("Ife", "Surveyor", 88100, "2009-09-09"),
    ("Lin", "Porter", None, "2024-01-02"),
    ("Hanna", None, 41250, None),
]

PEOPLE = [
    ("Soren", 41, "Glazier"),
    ("Amina", 19, "Baker"),
    ("Pavel", 41, "Baker"),
    ("Yuki", None, "Baker"),
    ("Clara", 63, None),
    ("Noor", 52, "Surveyor"),
]


def house_records():
    return [
        (i, 1.0, 2.0, year, square, people, region, town, address, address, service, None)
        for i, year, square, people, region, town, address, service in HOUSES
    ]


def houses(spark):
    return spark.createDataFrame(house_records(), HOUSES_RAW)


def logs(spark, records=LOGS):
    typed = [(ip, datetime.fromisoformat(ts), *rest) for ip, ts, *rest in records]
    return spark.createDataFrame(typed, WEB_LOGS)


def bought(spark, records=PURCHASED):
    return spark.createDataFrame(records, PURCHASES)


def write_register_csv(path, *, newline_in_field: bool = True, little_endian: bool = True):
    """The register as one UTF-16 file, byte-order mark first, as the source delivers it."""
    header = ",".join(HOUSES_RAW.fieldNames())

    def text(value):
        if value is None:
            return ""
        value = str(value)
        if not newline_in_field:
            value = value.replace("\n", " ")
        return f'"{value}"' if "\n" in value or " " in value else value

    lines = [",".join(map(text, record)) for record in house_records()]
    encoding = "utf-16-le" if little_endian else "utf-16-be"
    path.write_bytes(("\ufeff" + "\n".join([header, *lines]) + "\n").encode(encoding))
    return str(path)
