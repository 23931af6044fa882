"""Company-filing metrics on Spark: (company, fiscal year, metric) -> value.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing here starts a session, collects data or runs an action unless
its docstring says so.
"""

__version__ = "0.1.0"
