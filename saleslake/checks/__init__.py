"""The operators over the star-schema test tables, with equivalent SQL for comparison."""
