"""Every operator as a query over the test tables, each with the SQL it must agree with."""
