"""Usage metering, rating and billing as Spark DataFrame operators.

Every public function takes DataFrames and returns DataFrames.  Nothing in the
library reads the clock: the processing time is always an argument.
"""
