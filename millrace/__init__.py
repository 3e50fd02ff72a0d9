"""millrace: a PySpark-native engine for company-data pipelines.

Records from several sources are brought into one shape, resolved to companies,
linked to their career portals from snapshots of fetched pages, reconciled and
exported. Everything is expressed as DataFrame plans.
"""

#: Fixed value: a company qualifies with more employees than this.
MIN_EMPLOYEES = 1000
