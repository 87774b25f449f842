"""Keyweave: synthetic tables that join by construction, as Spark expressions.

Sub-packages:

* ``functions``  Column to Column: value generators, JSON search and edit
* ``operators``  DataFrame to DataFrame: tables, key file, items, checks
* ``sources``    table schemas, catalog tables, key files
* ``plans``      configurations, whole jobs, registered queries
"""
