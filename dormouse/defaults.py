"""Tags, names and periods that the source systems use, and
that results depend on. Everything a site may change is also an argument of
the function that uses it.
"""

# Permissions that let an account use the tracker.
ACCESS_PERMISSIONS = ("USE", "ADMINISTER")

# Licence role whose members consume a licence.
LICENCE_ROLE = "jira-software"

# Keys of the account attribute table; values are epoch milliseconds as text.
LAST_LOGIN_ATTRIBUTE = "login.lastLoginMillis"
LAST_AUTH_ATTRIBUTE = "lastAuthenticated"

# Change history field that records an assignment.
ASSIGNEE_FIELD = "assignee"

# Association type of a watched issue.
WATCH_ASSOCIATION = "WatchIssue"

# Audit rows that record a reactivated account: type, and end of the change text.
AUDIT_ACCOUNT_TYPE = "USER"
REACTIVATION_SUFFIX = '"from":"Inactive","to":"Active"}]'

# Members of this group are never listed as dormant.
EXEMPT_GROUP = "never-deactivate"

# Periods without activity after which an account is dormant.
TRACKER_MONTHS = 3
WIKI_MONTHS = 6
LOGIN_RULE_YEARS = 1

# The directory whose accounts can be changed; the others are read-only.
WRITABLE_DIRECTORY = 1
