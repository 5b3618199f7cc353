"""The operators run on the test tables: views, queries and the SQL that must agree with them."""
