"""Invented records and small helpers shared by the tests."""

from __future__ import annotations

import json

from feedloom.plans.employee import EMPLOYEE

KEY = "0123456789abcdef0123456789abcdef"

VALID = {
    "employee_id": "EMP0001",
    "first_name": "Mira",
    "last_name": "Solberg",
    "email": "mira.solberg@example.com",
    "phone_number": "5550001111",
    "hire_date": "2021-04-30",
    "department": "Logistics",
    "job_title": "Planner",
    "salary": "72000",
    "currency": "EUR",
    "employment_status": "Full-time",
    "manager_id": "MGR0007",
    "is_active": "true",
    "skills": "Routing;SQL",
    "address_street": "4, Harbour Lane",
    "address_city": "Bergen",
    "address_state": "Vestland",
    "address_postal_code": "5003",
    "address_country": "Norway",
    "emergency_contact_name": "Jon Solberg",
    "emergency_contact_relationship": "Sibling",
    "emergency_contact_phone": "5550002222",
    "emergency_contact_email": "jon@example.com",
}


def csv_cell(value) -> str:
    text = "" if value is None else str(value)
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n') else text


def csv_text(rows, columns=None) -> str:
    columns = columns or EMPLOYEE.csv_columns
    lines = [",".join(columns)]
    lines += [",".join(csv_cell(row.get(c)) for c in columns) for row in rows]
    return "\n".join(lines) + "\n"


def variation(number: int = 1, **changes):
    row = {**VALID, "employee_id": f"EMP{number:04d}"}
    row.update(changes)
    return row


def json_record(number: int = 1, **changes):
    row = variation(number)
    record = {}
    for field in EMPLOYEE.fields:
        if field.kind == "struct":
            record[field.name] = {c: row[f"{field.name}_{c}"] for c in field.children}
        elif field.kind == "list":
            record[field.name] = row[field.name].split(";")
        elif field.kind == "long":
            record[field.name] = int(row[field.name])
        elif field.kind == "boolean":
            record[field.name] = row[field.name] == "true"
        else:
            record[field.name] = row[field.name]
    record.update(changes)
    return record


def json_lines(records) -> str:
    return "\n".join(json.dumps(r, ensure_ascii=False) for r in records) + "\n"


def write(path, text: str) -> str:
    path.write_bytes(text.encode("utf-8"))
    return str(path)
