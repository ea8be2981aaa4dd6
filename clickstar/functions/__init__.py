"""Column functions; all but the IPv6 and script-text helpers are built-in expressions."""
