"""Column -> Column rules shared by operators, so each rule is written once."""
