"""Jobs made of the operators: the weekly load, the event report and the check queries."""
