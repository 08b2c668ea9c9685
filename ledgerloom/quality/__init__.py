"""Row rules with quarantine, table checks, expectation suites."""
