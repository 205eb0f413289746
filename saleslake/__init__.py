"""A sales lakehouse on Spark: landing files -> bronze -> silver -> gold, with data checks.

Python only builds plans here. Rows stay in the JVM from scan to write: no Python
function sees a row, and the only values read back are one-row facts (the newest
file, the newest batch, a version number) and lists bounded by the number of
months or files involved.
"""
