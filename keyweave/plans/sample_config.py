"""Sample configuration: four tables that share employee, department and company keys.

Fixed values: ranges, prefixes, option lists, formats and SQL text that results depend on.
"""

SCHEMAS = {
    "department": "department_id STRING, costcenter STRING, dept_name STRING",
    "employee": "employee_id STRING, dept_id STRING, employee_level STRING, employment_start_dt STRING, "
                "increment_dt STRING",
    "company": "company_id STRING, company_start_dt STRING",
    "trainings": "training_id STRING, training_name STRING",
}

_DEPARTMENT = {"minVal": 4000, "maxVal": 5000, "step": 1, "baseCol": "empid"}
_COMPANY = {"minVal": 1000, "maxVal": 2000, "step": 1, "baseCol": "deptid"}
_EMPLOYEE = {"minVal": 100000, "maxVal": 200000, "step": 1, "baseCol": "empid", "prefix": "X"}

SYNTHESIS = {
    "table_list": ["department", "employee", "company", "trainings"],
    "num_partitions": 8,
    "basemap": {
        "empid": {"minVal": 10000, "maxVal": 20000, "step": 1},
        "deptid": _DEPARTMENT,
        "companyid": _COMPANY,
    },
    "keymap": {
        "employee_id": _EMPLOYEE,
        "employee_number": _EMPLOYEE,
        "department_id": _DEPARTMENT,
        "company_id": _COMPANY,
        "dept_id": _DEPARTMENT,
        "costcenter": {"minVal": 1000, "maxVal": 2000, "step": 1, "baseCol": "deptid"},
        "training_id": {"minVal": 100, "maxVal": 200, "step": 1, "baseCol": "deptid"},
        "dept_start_date": {"datatype": "confdate", "val": "2022-10-24"},
        "employee_level": {"datatype": "faker", "fakerText": "word", "options": ["L1", "L2", "L3", "L4", "L5"],
                           "baseCol": "employee_id"},
        "manager_id": {"minVal": 100000, "maxVal": 200000, "step": 1, "baseCol": "employee_id", "prefix": "X"},
        "employment_start_dt": {"datatype": "date", "genType": "deltaDays", "deltaDays": 10},
        "company_ipo_dt": {"datatype": "date", "genType": "deltaDays", "deltaDays": 100},
        "training_name": {"datatype": "faker", "fakerText": "word", "options": ["ethics", "security"],
                          "baseCol": "training_id"},
    },
}

ITEMS = {
    "PKlst": ["PK1"],
    "PKdesc": {
        "PK1": {
            "SQL": "LPAD(concat_ws('-', LPAD(employee_id,10,0), LPAD(department_id,10,0)),22,'X-')",
            "ADDITIONAL_SQL": "LPAD(concat_ws('-', LPAD(costcenter,10,0), LPAD(department_id,10,0)),22,'X-')",
            "SK": {
                "type": "daterange",
                "start": "date_sub(as_of, 91)",
                "end": "as_of",
                "format": "yyyy-MM-dd HH:mm:ss",
                "interval_in_days": 1,
            },
            "Attrs": ["attr1", "create_time", "expTm", "sqltypeattr"],
            "attr1": {
                "type": "json",
                "jsonstr": '{"employee_id": "E001","dept_id": "D100","status_update": ""}',
                "replacement_map": {
                    "employee_id": "split(PK,'-')[0]",
                    "dept_id": "split(PK,'-')[1]",
                    "status_update": "split(ADDITIONAL_PK,'-')[0]",
                },
            },
            "create_time": {"type": "audit_date", "val": "as_of", "format": "yyyy-MM-dd HH:mm:ss"},
            "expTm": {"type": "relative_date", "base_date_column": "create_time",
                      "base_date_format": "yyyy-MM-dd HH:mm:ss", "delta_days": 100},
            "sqltypeattr": {"type": "sql", "attr_SQL": "split(PK,'-')[0]"},
        },
    },
}

#: The sample with ranges wide enough for very many seed ids: no key repeats below two thousand million of them.
WIDE_SYNTHESIS = {
    **SYNTHESIS,
    "basemap": {
        "empid": {"minVal": 1, "maxVal": 2_000_000_000, "step": 1},
        "deptid": {**_DEPARTMENT, "minVal": 1, "maxVal": 20_000_000},
        "companyid": {**_COMPANY, "minVal": 1, "maxVal": 200_000},
    },
    "keymap": {
        **SYNTHESIS["keymap"],
        "employee_id": {**_EMPLOYEE, "minVal": 1, "maxVal": 2_000_000_000},
        "department_id": {**_DEPARTMENT, "minVal": 1, "maxVal": 20_000_000},
        "dept_id": {**_DEPARTMENT, "minVal": 1, "maxVal": 20_000_000},
        "company_id": {**_COMPANY, "minVal": 1, "maxVal": 200_000},
    },
}
