"""tickweave: options-market bar and contract processing as lazy Spark DataFrame operators.

Every public operator takes and returns a DataFrame (plus plain parameters), builds only a
logical plan, never collects, and never reads the clock: "as of" dates are arguments.
"""

__version__ = "0.1.0"
