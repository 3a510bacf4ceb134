"""Table specs: which columns a feed has, where they land and under which key."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

TEXT = "string"
FLAG = "boolean"
WHOLE = "int"
RATIO = "double"
MONEY = "decimal(18,2)"
INSTANT = "timestamp_ntz"
DAY = "date"
TENANT = "CompanyId"


@dataclass(frozen=True)
class TableSpec:
    """One synchronised table.

    ``columns`` are the target columns in order; ``sources`` maps a target
    column to the feed field it is read from when the names differ (a dotted
    name reads a struct field). Columns named in ``dates`` go through the strict
    date parser. ``update`` lists what a match may change (default: all but the
    key). ``ts_col`` is the feed field the watermark follows.
    """

    name: str
    object: str
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    extract: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    dates: frozenset[str] = frozenset()
    sources: dict[str, str] = field(default_factory=dict)
    ts_col: str | None = "LastModifiedDate"
    update: tuple[str, ...] | None = None
    null_safe: bool = False
    semi_join: tuple[str, str, str] | None = None
    advance_on_empty: bool = False
    log_name: str | None = None

    @property
    def log_key(self) -> str:
        return self.log_name or self.name

    def type_of(self, column: str) -> str:
        return INSTANT if column in self.dates else self.types.get(column, TEXT)

    def source_of(self, column: str) -> str:
        return self.sources.get(column, column)

    @property
    def update_columns(self) -> list[str]:
        if self.update is not None:
            return list(self.update)
        return [c for c in self.columns if c not in self.keys]

    @property
    def schema(self) -> str:
        return ", ".join(f"`{c}` {self.type_of(c)}" for c in self.columns)

    @property
    def text_fields(self) -> dict[str, str]:
        """Fields of a landed extract as a text format holds them: everything is text, and typed later, where a value
        that does not fit can be set apart with its reason."""
        fields: dict[str, str] = {}
        for name in self.extract:
            head, _, leaf = name.partition(".")
            if leaf:
                known = fields.get(head, "struct<>")[7:-1]
                fields[head] = f"struct<{known + ', ' if known else ''}{leaf}: {TEXT}>"
            else:
                fields[head] = TEXT
        return fields | ({self.ts_col: TEXT} if self.ts_col else {}) | {TENANT: TEXT}

    def with_tenant(self, column: str = "CompanyId") -> "TableSpec":
        """The same table with the tenant as a column and part of the key."""
        if column in self.columns:
            return self
        return replace(self, columns=(column, *self.columns), keys=(column, *self.keys))


def _words(text: str) -> tuple[str, ...]:
    return tuple(text.split())


# Feed fields, target columns, keys and types of the CRM tables.

ACCOUNTS = TableSpec(
    name="accounts",
    object="Account",
    keys=("SalesForceId",),
    columns=_words("""
        SalesForceId Name Type BillingStreet BillingCity BillingState BillingPostalCode BillingCountry
        ShippingStreet ShippingCity ShippingState ShippingPostalCode ShippingCountry Phone Fax
        AccountNumber Website PhotoUrl Sic Industry AnnualRevenue NumberOfEmployees Ownership
        TickerSymbol Description Rating OwnerId CreatedDate CreatedById LastModifiedDate
        LastModifiedById CleanStatus AccountSource DunsNumber TradeStyle CustomerPriority SLA
        NumberOfLocations UpSellOpportunity SLASerialNumber SLAExpirationDate IsDeleted
    """),
    extract=_words("""
        Id Name Type BillingStreet BillingCity BillingState BillingPostalCode BillingCountry
        ShippingStreet ShippingCity ShippingState ShippingPostalCode ShippingCountry Phone Fax
        AccountNumber Website PhotoUrl Sic Industry AnnualRevenue NumberOfEmployees Ownership
        TickerSymbol Description Rating OwnerId CleanStatus AccountSource DunsNumber CreatedDate
        CreatedById LastModifiedDate LastModifiedById
    """),
    types={"AnnualRevenue": MONEY, "NumberOfEmployees": WHOLE, "IsDeleted": FLAG},
    dates=frozenset({"CreatedDate", "LastModifiedDate", "SLAExpirationDate"}),
    sources={
        "SalesForceId": "Id",
        "TradeStyle": "TradeStyle__c",
        "CustomerPriority": "CustomerPriority__c",
        "SLA": "SLA__c",
        "NumberOfLocations": "NumberOfLocations__c",
        "UpSellOpportunity": "UpSellOpportunity__c",
        "SLASerialNumber": "SLASerialNumber__c",
        "SLAExpirationDate": "SLAExpirationDate__c",
    },
)

OPPORTUNITIES = TableSpec(
    name="opportunities",
    object="Opportunity",
    keys=("SalesforceId",),
    columns=_words("""
        SalesforceId IsDeleted AccountId IsPrivate Name Description StageName Amount Probability
        ExpectedRevenue TotalOpportunityQuantity CloseDate Type LeadSource IsClosed IsWon
        ForecastCategory ForecastCategoryName OwnerId OwnerName CreatedDate CreatedById
        LastModifiedDate LastModifiedById PushCount LastStageChangeDate FiscalQuarter FiscalYear
        Fiscal ContactId LastViewedDate LastReferenceDate HasOpenActivity HasOverdueTask
        DeliveryInstallationStatus OrderNumber CurrentGenerators MainCompetitors OwnerEmail
    """),
    extract=_words("""
        Id AccountId IsPrivate Name Description StageName Amount Probability ExpectedRevenue
        TotalOpportunityQuantity CloseDate Type LeadSource IsClosed IsWon ForecastCategory
        ForecastCategoryName OwnerId Owner.Name CreatedDate CreatedById LastModifiedDate
        LastModifiedById PushCount LastStageChangeDate FiscalQuarter FiscalYear Fiscal ContactId
        LastViewedDate LastReferencedDate HasOpenActivity HasOverdueTask Owner.Email
    """),
    types={
        "IsDeleted": FLAG, "IsPrivate": FLAG, "Amount": MONEY, "Probability": RATIO,
        "ExpectedRevenue": MONEY, "TotalOpportunityQuantity": RATIO, "CloseDate": DAY,
        "IsClosed": FLAG, "IsWon": FLAG, "PushCount": WHOLE, "FiscalQuarter": WHOLE,
        "FiscalYear": WHOLE, "HasOpenActivity": FLAG, "HasOverdueTask": FLAG,
    },
    dates=frozenset({
        "CreatedDate", "LastModifiedDate", "LastStageChangeDate", "LastViewedDate",
        "LastReferenceDate",
    }),
    sources={
        "SalesforceId": "Id",
        "OwnerName": "Owner.Name",
        "OwnerEmail": "Owner.Email",
        "LastReferenceDate": "LastReferencedDate",
    },
)

CONTACTS = TableSpec(
    name="contacts",
    object="Contact",
    keys=("SalesforceId",),
    columns=_words("""
        SalesforceId IsDeleted MasterRecordId AccountId LastName FirstName Salutation Name
        OtherStreet OtherCity OtherState OtherPostalCode OtherCountry MailingStreet MailingCity
        MailingState MailingPostalCode MailingCountry Phone Fax MobilePhone HomePhone OtherPhone
        AssistantPhone Email Title Department AssistantName LeadSource Description OwnerId
        CreatedDate LastModifiedDate LastActivityDate LastCURequestDate LastCUUpdateDate
        LastViewedDate LastReferencedDate EmailBouncedReason EmailBouncedDate IsEmailBounced
        PhotoUrl Jigsaw JigsawContactId CleanStatus IndividualId Level__c Languages__c
    """),
    extract=_words("""
        Id IsDeleted MasterRecordId AccountId LastName FirstName Salutation Name OtherStreet
        OtherCity OtherState OtherPostalCode OtherCountry MailingStreet MailingCity MailingState
        MailingPostalCode MailingCountry Phone Fax MobilePhone HomePhone OtherPhone AssistantPhone
        Email Title Department AssistantName LeadSource Description OwnerId CreatedDate
        LastModifiedDate LastActivityDate LastCURequestDate LastCUUpdateDate LastViewedDate
        LastReferencedDate EmailBouncedReason EmailBouncedDate IsEmailBounced PhotoUrl Jigsaw
        JigsawContactId CleanStatus IndividualId
    """),
    types={"IsDeleted": FLAG, "IsEmailBounced": FLAG},
    dates=frozenset({
        "CreatedDate", "LastModifiedDate", "LastActivityDate", "LastCURequestDate",
        "LastCUUpdateDate", "LastViewedDate", "LastReferencedDate", "EmailBouncedDate",
    }),
    sources={"SalesforceId": "Id"},
)

ACTIVITIES = TableSpec(
    name="opportunity_activities",
    object="Task",
    keys=("SalesforceId",),
    columns=_words("""
        SalesforceId WhatId WhoId AccountId Subject ActivityDate Status Priority OwnerId
        CreatedDate IsClosed IsDeleted CallType CallDisposition CallObject CreatedById
        Description CompletedDateTime TaskSubType
    """),
    extract=_words("""
        Id AccountId WhatId WhoId Subject ActivityDate Status Priority OwnerId CreatedDate
        IsClosed IsDeleted CallType CallDisposition CallObject CreatedById Description
        CompletedDateTime TaskSubType
    """),
    types={"IsClosed": FLAG, "IsDeleted": FLAG},
    dates=frozenset({"ActivityDate", "CreatedDate", "CompletedDateTime"}),
    sources={"SalesforceId": "Id"},
    semi_join=("WhatId", "opportunities", "Id"),
)

HISTORY = TableSpec(
    name="opportunity_history",
    object="OpportunityHistory",
    keys=("SalesforceId",),
    columns=_words("""
        SalesforceId OpportunityId CreatedDate StageName Amount ExpectedRevenue CloseDate
        Probability ForecastCategory IsDeleted PrevAmount PrevCloseDate
    """),
    extract=_words("""
        Id OpportunityId CreatedDate Amount PrevAmount CloseDate PrevCloseDate ExpectedRevenue
        Probability StageName ForecastCategory IsDeleted
    """),
    types={
        "Amount": MONEY, "ExpectedRevenue": MONEY, "Probability": RATIO, "IsDeleted": FLAG,
        "PrevAmount": MONEY,
    },
    dates=frozenset({"CreatedDate", "CloseDate", "PrevCloseDate"}),
    sources={"SalesforceId": "Id"},
    ts_col="CreatedDate",
)

USERS = TableSpec(
    name="users",
    object="User",
    keys=("Id",),
    columns=_words("""
        Id Username LastName FirstName Name CompanyName Division Department Title Street City
        State PostalCode Country Email EmailPreferencesAutoBcc EmailPreferencesAutoBccStayInTouch
        EmailPreferencesStayInTouchReminder SenderEmail SenderName MobilePhone Alias
        CommunityNickname BadgeText IsActive TimeZoneSidKey UserRoleId LocaleSidKey
        ReceivesInfoEmails EmailEncodingKey ProfileId UserType LanguageLocaleKey EmployeeNumber
        CreatedDate CreatedById LastModifiedDate LastModifiedById AboutMe
    """),
    extract=_words("""
        Id Username LastName FirstName Name CompanyName Division Department Title Street City
        State PostalCode Country Email EmailPreferencesAutoBcc EmailPreferencesAutoBccStayInTouch
        EmailPreferencesStayInTouchReminder SenderEmail SenderName MobilePhone Alias
        CommunityNickname BadgeText IsActive TimeZoneSidKey UserRoleId LocaleSidKey
        ReceivesInfoEmails ReceivesAdminInfoEmails EmailEncodingKey ProfileId UserType
        LanguageLocaleKey EmployeeNumber CreatedDate CreatedById LastModifiedDate
        LastModifiedById AboutMe
    """),
    types={
        "EmailPreferencesAutoBcc": FLAG, "EmailPreferencesAutoBccStayInTouch": FLAG,
        "EmailPreferencesStayInTouchReminder": FLAG, "IsActive": FLAG,
        "ReceivesInfoEmails": FLAG, "ReceivesAdminInfoEmails": FLAG,
    },
    dates=frozenset({"CreatedDate", "LastModifiedDate"}),
)

CALL_STAGES = TableSpec(
    name="callstages",
    object="OpportunityStage",
    keys=("SalesforceId",),
    columns=_words("SalesforceId IsActive CallStage SortOrder"),
    extract=_words("Id MasterLabel IsActive SortOrder"),
    types={"IsActive": FLAG, "SortOrder": WHOLE},
    sources={"SalesforceId": "Id", "CallStage": "MasterLabel"},
)

CUSTOM_ATTRIBUTES = TableSpec(
    name="custom_attributes",
    object="CustomField",
    keys=("CompanyId", "SalesforceId"),
    columns=_words("""
        SalesforceId CompanyId ObjectType Name Label Description Fieldtype DataType
        HasUniqueValue IsActive CreatedBy UpdatedBy CreatedAt UpdatedAt
    """),
    types={"HasUniqueValue": FLAG, "IsActive": FLAG},
    dates=frozenset({"CreatedAt", "UpdatedAt"}),
    sources={
        "SalesforceId": "CustomFieldId",
        "ObjectType": "Object",
        "Fieldtype": "FieldType",
        "HasUniqueValue": "IsUnique",
    },
    ts_col=None,
)

CUSTOM_VALUES = TableSpec(
    name="custom_values",
    object="CustomField",
    keys=("CompanyId", "ObjectType", "ExternalId", "Type", "Name"),
    columns=_words("CompanyId ObjectType ExternalId Type Name Value CreatedAt UpdatedAt"),
    dates=frozenset({"CreatedAt", "UpdatedAt"}),
    sources={"ObjectType": "Object", "ExternalId": "record_id", "Type": "DataType", "Value": "value"},
    update=("Value", "UpdatedAt"),
    null_safe=True,
    advance_on_empty=True,
    ts_col=None,
)

# Feeds that describe the custom fields of an object; a page of them names its object and tenant.
METADATA_FEEDS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        TableSpec(
            name="custom_fields", object="CustomField", keys=("Id",), columns=("Id",), ts_col=None,
            extract=_words("Id DeveloperName CreatedDate CreatedById LastModifiedDate LastModifiedById"),
        ),
        TableSpec(
            name="definitions", object="FieldDefinition", keys=("QualifiedApiName",), columns=("QualifiedApiName",), ts_col=None,
            extract=_words("QualifiedApiName Label DataType Description"),
        ),
        TableSpec(
            name="particles", object="EntityParticle", keys=("QualifiedApiName",), columns=("QualifiedApiName",), ts_col=None,
            extract=_words("FieldDefinition.QualifiedApiName IsUnique IsDeprecatedAndHidden"),
            types={"IsUnique": FLAG, "IsDeprecatedAndHidden": FLAG},
        ),
    )
}

SYNC_LOG = TableSpec(
    name="sync_log",
    object="sync_log",
    keys=("table_name", "CompanyId"),
    columns=_words("table_name last_sync_time created_at CompanyId"),
    types={"last_sync_time": INSTANT, "created_at": INSTANT},
    ts_col=None,
)

# Which rows of the quarantine have been dealt with.
SETTLED = TableSpec(
    name="settled",
    object="settled",
    keys=("feed", "run", "digest"),
    columns=_words("feed run digest outcome settled_at"),
    types={"settled_at": INSTANT},
    ts_col=None,
)

CONFIG = TableSpec(
    name="config",
    object="config",
    keys=("Id",),
    columns=_words("""
        Id ProviderName ServiceType ExpireAt UserId CreatedBy CreatedAt Version ModifiedBy
        ModifiedAt IsDeleted CompanyId Metadata Status
    """),
    types={
        "ProviderName": WHOLE, "ServiceType": WHOLE, "ExpireAt": INSTANT, "CreatedAt": INSTANT,
        "Version": WHOLE, "ModifiedAt": INSTANT, "IsDeleted": WHOLE, "Status": WHOLE,
    },
    update=("ExpireAt", "ModifiedBy", "ModifiedAt", "Metadata", "Status"),
    ts_col=None,
)

FEEDS: dict[str, TableSpec] = {
    s.name: s
    for s in (ACCOUNTS, OPPORTUNITIES, CONTACTS, ACTIVITIES, HISTORY, USERS, CALL_STAGES)
}

CUSTOM_FIELD_OBJECTS = ("Account", "Contact", "Opportunity", "User")

# Route of a pushed body -> object it carries.
ROUTES: dict[str, str] = {
    "accounts": "Account",
    "opportunities": "Opportunity",
    "contacts": "Contact",
    "opportunity_activities": "Task",
    "users": "User",
}

# Config classes in order of preference: (ProviderName, ServiceType).
CONFIG_CLASSES = ((3, 3), (2, 2))


def custom_values_log_key(object_name: str) -> str:
    return f"CrmAttributeValues_{object_name}"
