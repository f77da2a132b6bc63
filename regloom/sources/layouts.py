"""Column layouts of the two register snapshots.

A layout ties each header of the published file to the name and type it has in
the cleaned table. Headers marked ``late`` exist only in the wider of the two
header vintages; an older file simply lacks them.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    header: str
    name: str
    type: str
    late: bool = False


@dataclass(frozen=True)
class Layout:
    dataset: str
    fields: tuple[Field, ...]

    @property
    def renames(self) -> dict[str, str]:
        return {f.header: f.name for f in self.fields}

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def headers(self) -> list[str]:
        return [f.header for f in self.fields]

    @property
    def early_headers(self) -> list[str]:
        return [f.header for f in self.fields if not f.late]


def _layout(dataset: str, table: str) -> Layout:
    rows = (line.split() for line in table.strip().splitlines())
    return Layout(dataset, tuple(Field(r[0], r[1], r[2], "late" in r[3:]) for r in rows))


# Published header, cleaned name, type, and "late" for headers of
# the 53-column vintage only.
ESTABLISHMENTS = _layout(
    "StockEtablissement",
    """
    siren                                           company_number               string
    nic                                             localnic                     string
    siret                                           siret                        string
    statutDiffusionEtablissement                    distributionStatus           string
    dateCreationEtablissement                       EstablishmentDate            string
    trancheEffectifsEtablissement                   EmployeeCountCategory        string
    anneeEffectifsEtablissement                     EmployeeCountCategoryYear    int
    activitePrincipaleRegistreMetiersEtablissement  mainNAF                      string
    dateDernierTraitementEtablissement              LastNAFUpdate                string
    etablissementSiege                              RegisteredOfficeBool         boolean
    nombrePeriodesEtablissement                     PeriodNumber                 int
    dernierNumeroVoieEtablissement                  LastAddressNumber            string  late
    indiceRepetitionDernierNumeroVoieEtablissement  DateOfLastAddressNumber      string  late
    identifiantAdresseEtablissement                 InstitutionAddressID         string  late
    coordonneeLambertAbscisseEtablissement          LambertCoordinateX           double  late
    coordonneeLambertOrdonneeEtablissement          LambertCoordinateY           double  late
    complementAdresseEtablissement                  AddressBuildingBlock         string
    numeroVoieEtablissement                         AddressNumber                string
    indiceRepetitionEtablissement                   AddressNumberSubUnit         string
    typeVoieEtablissement                           AddressUniqueIdentifier      string
    libelleVoieEtablissement                        AddressLabel                 string
    codePostalEtablissement                         AddressPostcode              string
    libelleCommuneEtablissement                     AddressMunicipalityLabel     string
    libelleCommuneEtrangerEtablissement             AddressForeignMunicipality   string
    distributionSpecialeEtablissement               AddressPOBox                 string
    codeCommuneEtablissement                        AddressCommuneCode           string
    codeCedexEtablissement                          AddressCEDEXCode             string
    libelleCedexEtablissement                       AddressCEDEXLabel            string
    codePaysEtrangerEtablissement                   AddressOverseasCountryCode   string
    libellePaysEtrangerEtablissement                AddressOverseasCountryLabel  string
    complementAdresse2Etablissement                 AddressBuildingBlock2        string
    numeroVoie2Etablissement                        AddressNumber2               string
    indiceRepetition2Etablissement                  AddressNumberSubUnit2        string
    typeVoie2Etablissement                          AddressUniqueIdentifier2     string
    libelleVoie2Etablissement                       AddressLabel2                string
    codePostal2Etablissement                        AddressPostcode2             string
    libelleCommune2Etablissement                    AddressMunicipalityLabel2    string
    libelleCommuneEtranger2Etablissement            AddressForeignMunicipality2  string
    distributionSpeciale2Etablissement              AddressPOBox2                string
    codeCommune2Etablissement                       AddressCommuneCode2          string
    codeCedex2Etablissement                         AddressCEDEXCode2            string
    libelleCedex2Etablissement                      AddressCEDEXLabel2           string
    codePaysEtranger2Etablissement                  AddressOverseasCountryCode2  string
    libellePaysEtranger2Etablissement               AddressOverseasCountryLabel2 string
    dateDebut                                       DateOfBusinessStart          string
    etatAdministratifEtablissement                  AdministrativeStatus         string
    enseigne1Etablissement                          EstablishmentSign1           string
    enseigne2Etablissement                          EstablishmentSign2           string
    enseigne3Etablissement                          EstablishmentSign3           string
    denominationUsuelleEtablissement                CommonCompanyName            string
    activitePrincipaleEtablissement                 APETCode                     string
    nomenclatureActivitePrincipaleEtablissement     APETCodeCategory             string
    caractereEmployeurEtablissement                 EmploymentType               string
    """,
)

# Published header, cleaned name, type.
LEGAL_UNITS = _layout(
    "StockUniteLegale",
    """
    siren                                      company_number                    string
    statutDiffusionUniteLegale                 LegalUnitBroadcastID              string
    unitePurgeeUniteLegale                     PurgeStatus                       string
    dateCreationUniteLegale                    DateCreated                       string
    sigleUniteLegale                           LegalAcronym                      string
    sexeUniteLegale                            GenderOfPerson                    string
    prenom1UniteLegale                         NaturalName1                      string
    prenom2UniteLegale                         NaturalName2                      string
    prenom3UniteLegale                         NaturalName3                      string
    prenom4UniteLegale                         NaturalName4                      string
    prenomUsuelUniteLegale                     PreferredName                     string
    pseudonymeUniteLegale                      pseudonym                         string
    identifiantAssociationUniteLegale          RNANumber                         string
    trancheEffectifsUniteLegale                EmployeeCountCategory             string
    anneeEffectifsUniteLegale                  EmployeeCountCategoryDateUpdated  int
    dateDernierTraitementUniteLegale           LegalUnitUpdated                  string
    nombrePeriodesUniteLegale                  TimeAsLegalUnit                   int
    categorieEntreprise                        BusinessCategory                  string
    anneeCategorieEntreprise                   YearOfBusinessCategoryAssignment  int
    dateDebut                                  DateOfBusinessStart               string
    etatAdministratifUniteLegale               AdministrativeStatus              string
    nomUniteLegale                             PersonBirthName                   string
    nomUsageUniteLegale                        PersonUsedName                    string
    denominationUniteLegale                    LegalEntityName                   string
    denominationUsuelle1UniteLegale            LegalEntityName1                  string
    denominationUsuelle2UniteLegale            LegalEntityName2                  string
    denominationUsuelle3UniteLegale            LegalEntityName3                  string
    categorieJuridiqueUniteLegale              LegalCategory                     string
    activitePrincipaleUniteLegale              NAFCategory                       string
    nomenclatureActivitePrincipaleUniteLegale  ActiveLegalUnit                   string
    nicSiegeUniteLegale                        NICAssignment                     string
    economieSocialeSolidaireUniteLegale        SSEBool                           string
    societeMissionUniteLegale                  MissionDrivenCompanyBool          string
    caractereEmployeurUniteLegale              EmployerNature                    string
    """,
)
