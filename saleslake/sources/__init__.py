"""Where data comes from and goes to: workbooks, layer files, rates, catalog tables, staging."""
