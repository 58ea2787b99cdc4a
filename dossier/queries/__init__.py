"""The registered queries on the test tables, and the SQL each must agree with."""
