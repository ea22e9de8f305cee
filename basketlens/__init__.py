"""basketlens: retail customer analytics expressed as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; nothing here starts or
stops a session, and no table-sized data passes through the driver.
"""
